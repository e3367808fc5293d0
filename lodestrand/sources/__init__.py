"""Readers, writers and extractors at the edges of the engine."""
