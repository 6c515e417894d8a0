"""Operators for building training data from documents, vectors and web pages; nothing else in the library imports them."""
