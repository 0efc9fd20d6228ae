"""Readers and writers for the file formats of small-RNA work."""
