"""Readers and writers: layered storage, the company registry, tables, external feeds and serving sinks."""
