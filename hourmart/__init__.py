"""Hourly clickstream marts built with Spark DataFrames."""
