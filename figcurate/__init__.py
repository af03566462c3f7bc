"""figcurate: PySpark-native curation of figure-level image–text data."""
