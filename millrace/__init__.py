"""Warehouse analytics and ELT jobs written directly on Spark DataFrames."""
