"""Lodestone: point-in-time market research and corpus preparation as Spark DataFrames."""
