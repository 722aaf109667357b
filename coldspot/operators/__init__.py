"""Relational operators of the reports."""
