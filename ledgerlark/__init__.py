"""Spark-native loan analytics: entity split, cleaning, quality, marts and scoring."""
