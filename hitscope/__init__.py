"""Web access-log analytics on Spark: parse, count, rank and alert with DataFrames."""
