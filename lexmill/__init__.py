"""A Spark-native engine for document collections with entity annotations."""
