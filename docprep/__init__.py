"""docprep: document-corpus preparation expressed as Spark DataFrame jobs."""
