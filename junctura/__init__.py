"""Differential intron usage on Spark, with operators for training data beside it."""
