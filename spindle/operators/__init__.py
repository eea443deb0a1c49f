"""Operators over DataFrames: projection, keys, merging, checks, cubes, slices, joins."""
