"""Lakehouse analytics jobs written as functions over Spark DataFrames."""
