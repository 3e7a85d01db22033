"""siltstone: a PySpark-native engine for debt-event analytics and corpus preparation."""

__version__ = "0.1.0"
