"""Spark-native retail data toolkit: generators, layout, checks and queries."""
