"""A PySpark-native engine for decision records."""
