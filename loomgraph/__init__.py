"""loomgraph: a PySpark-native engine that turns source repositories into a queryable graph."""

__version__ = "0.1.0"
