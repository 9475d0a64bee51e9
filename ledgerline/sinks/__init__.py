"""Writes: Parquet/CSV files and the versioned snapshot table store."""
