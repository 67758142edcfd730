"""A Spark-native engine for wiki corpora: extraction, graph, retrieval, state and data preparation."""
