"""Readers and writers: databases over JDBC, ORC and Parquet folders, catalog tables, labelled files."""
