"""Readers, writers and recorded providers."""
