"""Spark-native cleaning, normalising and auditing of extracted documents."""
