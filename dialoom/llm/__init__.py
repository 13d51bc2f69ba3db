"""Operators for preparing dialogue and document corpora for language-model training."""
