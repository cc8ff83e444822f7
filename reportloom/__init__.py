"""Spark-native reports over complaint-style event tables, feeds and document collections."""
