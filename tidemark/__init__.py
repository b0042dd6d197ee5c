"""tidemark: change-data-capture layers (raw, silver, gold) as PySpark jobs."""
