"""Relational analytics over machine-code corpora, on Spark."""
