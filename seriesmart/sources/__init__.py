"""Readers and writers: delimited text, archives, workbooks, snapshots, tables."""
