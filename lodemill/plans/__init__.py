"""Named queries over the corpus tables, each with the SQL it must equal where SQL can say it."""
