"""Readers and writers: files, partitioned tables, JDBC."""
