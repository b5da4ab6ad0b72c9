"""Spark-native analytics for annotation tables: sources, operators, functions, plans, streaming."""
