"""Operators for preparing text corpora: one module each, and their queries in `queries`."""
