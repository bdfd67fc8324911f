"""Spark-native preparation, scoring and reporting for labelled news corpora."""
