"""Signal, interval and contact analytics on PySpark DataFrames."""
