"""Readers and writers: lake files, tables, streams, source databases."""
