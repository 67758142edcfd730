"""Column functions: titles, hashes, URLs, text clean-up, vectors."""
