"""Readers, writers and the test-bed adapters."""
