"""Cairn: provenance-first analytics on Spark DataFrames."""
