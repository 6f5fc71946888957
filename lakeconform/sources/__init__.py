"""Readers, writers, lineage stamps and the layout of the lake."""
