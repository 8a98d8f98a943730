"""Operators for pipelines of language-model training data. Nothing outside this package imports it."""
