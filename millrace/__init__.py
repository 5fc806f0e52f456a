"""millrace: a PySpark-native engine for grounded training data and entity resolution."""

__version__ = "0.1.0"
