"""Text search and analytics over a table of documents, as Spark DataFrame jobs."""
