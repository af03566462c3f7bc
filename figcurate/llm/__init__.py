"""Operators on text and records for language-model data; nothing outside this subpackage imports it."""
