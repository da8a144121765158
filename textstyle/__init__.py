"""Stylometry of large text collections on Spark DataFrames."""
