"""PySpark-native analytics for public-transport demand data."""
