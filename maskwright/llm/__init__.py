"""Operators and the corpus pipeline for preparing language-model training data."""
