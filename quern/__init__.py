"""Quern: a PySpark-native engine that mills raw text corpora into training data."""
