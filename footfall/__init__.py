"""Session analytics over user behaviour logs, written for PySpark.

Every function takes DataFrames and returns DataFrames; the caller owns the
SparkSession. See README.md for the map of modules.
"""
