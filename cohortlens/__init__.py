"""Cohort expression analytics on Spark DataFrames."""
