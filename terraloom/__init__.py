"""PySpark-native analytics for versioned, graph-shaped geographic data."""
