"""Spark-native extraction and querying of bitemporal facts from conversations."""
