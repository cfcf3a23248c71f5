"""Corvane: record curation and training-data preparation on Spark DataFrames."""
