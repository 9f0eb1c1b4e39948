"""Readers and writers: CSV and table sources, published tables, index sink."""
