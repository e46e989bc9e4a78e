"""Operators for text corpora used as training data; nothing else here imports them."""
