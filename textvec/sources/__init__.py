"""Readers of text files, token files and embedding files."""
