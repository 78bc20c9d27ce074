"""Operators on training corpora: filters, joins, packing, encodings, vector search."""
