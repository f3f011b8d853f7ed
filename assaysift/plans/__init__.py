"""Whole pipelines built from the operators."""
