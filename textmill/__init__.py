"""textmill: prepare text for semantic retrieval with Spark."""
