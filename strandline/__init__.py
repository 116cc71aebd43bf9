"""Cohort-scale somatic variant analytics on Spark DataFrames."""
