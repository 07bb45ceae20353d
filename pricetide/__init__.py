"""Keyed price tables, token search and update-latency reports on Spark DataFrames."""
