"""Readers, raw-document parsers and writers."""
