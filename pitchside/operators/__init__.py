"""Relational operators that take any DataFrame and column names."""
