"""Operators that prepare training data for language models."""
