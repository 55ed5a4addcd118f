"""PySpark-native change monitoring of regulatory documents."""
