"""Readers and writers for the text formats."""
