"""Composite reports and plan helpers."""
