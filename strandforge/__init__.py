"""Probe design on Spark: DataFrame in, DataFrame out."""
