"""Reading raw tables: CSV ingest, parquet, catalog and JDBC."""
