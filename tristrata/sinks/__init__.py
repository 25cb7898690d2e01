"""Batch writers: files, catalog tables, JDBC, keyed merge."""
