"""flashmill: a PySpark-native analytics engine for short financial news."""

__version__ = "0.1.0"
