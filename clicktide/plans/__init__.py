"""Whole data products composed of operators."""
