"""Readers and writers of the pipeline's tables and files."""
