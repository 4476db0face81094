"""hallowgrid: Spark-native operators over place-based public records."""
