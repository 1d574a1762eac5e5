"""punji: a Spark-native engine that turns page extracts into a searchable archive."""
