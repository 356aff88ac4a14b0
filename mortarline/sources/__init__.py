"""Readers and writers for the file shapes the operators consume and produce."""
