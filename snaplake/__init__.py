"""snaplake: a Spark-native snapshot-lake analytics engine."""
__version__ = "0.1.0"
