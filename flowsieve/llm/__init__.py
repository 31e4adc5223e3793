"""Operators for training-data corpora, their registered queries and oracle SQL."""
