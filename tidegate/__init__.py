"""Message-queue ingestion on Spark: one set of column transforms for tables and streams."""
