"""Relational and data-preparation operators, each a function from DataFrames to DataFrames."""
