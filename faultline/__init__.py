"""Spark-native detection of faulty wafers in wide semiconductor sensor data."""
