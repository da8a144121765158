"""Readers and writers of stored files and tables."""
