"""A PySpark-native engine for curating, matching and cleaning media-library data."""
