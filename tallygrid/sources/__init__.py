"""Readers, writers and table swaps."""
