"""Readers, vocabulary files, the shared scratch folder and writers."""
