"""Spark-native preparation of wide observation tables and regression modelling on them."""
