"""Operators for training-data pipelines, each written over Spark DataFrames."""
