"""Operators over text, pages and vectors for preparing training data; nothing else in the library imports this."""
