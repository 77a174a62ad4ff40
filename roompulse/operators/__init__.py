"""User-level analytics: each function maps DataFrames to one DataFrame."""
