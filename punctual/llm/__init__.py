"""Operators for text corpora and mergeable statistics; nothing else in the package imports them."""
