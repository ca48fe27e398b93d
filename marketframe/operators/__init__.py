"""Relational operators: every function maps lazy DataFrames to a lazy DataFrame."""
