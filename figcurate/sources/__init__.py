"""Readers, writers and storage helpers."""
