"""Operators for large text and training-data tables, and their queries."""
