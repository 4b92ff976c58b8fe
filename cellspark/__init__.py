"""Spark-native tables for single-cell expression data: ranked gene sentences, ages, splits, summaries."""
