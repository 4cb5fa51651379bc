"""Operators for text used in language-model training data."""
