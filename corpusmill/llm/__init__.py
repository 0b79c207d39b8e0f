"""Operators for preparing language-model training data. Nothing else in corpusmill imports this subpackage."""
