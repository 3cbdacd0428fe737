"""Connectors: delimited files, Parquet tables, JDBC (read and write)."""
