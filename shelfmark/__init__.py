"""Spark-native operators for searchable media and document catalogs."""
