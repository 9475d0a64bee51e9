"""Raw inputs: Parquet and CSV files, JDBC tables, and the test-data adapter."""
