"""Operators for large text and vector corpora, and their queries."""
