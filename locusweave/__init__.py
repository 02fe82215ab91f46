"""Spark-native genomic table analytics."""
