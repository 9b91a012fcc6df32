"""Spark-native analysis of large observation, play-count and feature tables."""
