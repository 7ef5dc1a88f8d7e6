"""Spark-native geospatial entity discovery: operators, sources, functions, plans and streaming."""

__version__ = "0.1.0"
