"""Analytics for live-shopping broadcasts, written as Spark DataFrame plans.

Operators are plain functions from DataFrames to DataFrames.  They stay lazy,
take every parameter explicitly and compute all rooms in one job.
"""
