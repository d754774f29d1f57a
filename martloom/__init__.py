"""Retail data marts, incremental rebuilds, text sentiment and data quality on Spark DataFrames."""
