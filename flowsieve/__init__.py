"""flowsieve: Spark-native analytics and detection over labelled flow tables."""

__version__ = "0.1.0"
MODEL_VERSION = "1.0.0"
