"""Readers: delimited files, Parquet, workbooks, tables, message streams."""
