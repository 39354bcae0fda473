"""corpusflow: Spark-native catalogue-to-corpus pipeline operators."""

__version__ = "0.1.0"
