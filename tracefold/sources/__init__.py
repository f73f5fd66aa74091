"""Readers and writers: delimited text and PNML model files."""
