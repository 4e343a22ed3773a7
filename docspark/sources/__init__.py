"""Readers and parsers for raw documents."""
