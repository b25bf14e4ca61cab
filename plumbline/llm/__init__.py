"""Operators for large training corpora: deduplication, cleaning, formats and packing."""
