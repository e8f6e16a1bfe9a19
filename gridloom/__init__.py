"""Spark-native engine that turns page fragments into comparable text and tables."""
