"""Operators for preparing training data from text corpora."""
