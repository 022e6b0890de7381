"""Operators over DataFrames: search, joins, lists, statistics, sampling."""
