"""Operators: each takes and returns DataFrames, so batch and streaming plans share them."""
