"""Spark-native curation, evaluation and scoring of labelled text data."""
