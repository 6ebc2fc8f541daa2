"""Table extraction, quote and user-record ingestion, and keyed message streams on Spark."""
