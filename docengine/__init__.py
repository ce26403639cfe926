"""Spark-native enrichment of entity tables from large document collections."""
