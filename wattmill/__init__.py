"""PySpark-native medallion analytics for energy-market data."""

__version__ = "0.1.0"
