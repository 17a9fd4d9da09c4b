"""Spark-native operators for isoform evidence and generic tables."""
