"""Operators for text corpora used as training data; nothing else in the library imports them."""
