"""Loan-state analytics on Spark DataFrames."""
