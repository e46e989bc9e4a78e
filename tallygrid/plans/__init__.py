"""Whole jobs: read, compute with the operators, write."""
