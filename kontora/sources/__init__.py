"""Readers, writers and the banking tables."""
