"""PySpark-native quantification of plate-based single-cell read tables."""
