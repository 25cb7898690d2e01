"""Readers: files, Kafka and its replay, catalog tables, JDBC, schema inference."""
