"""Raster time-series and run-metric analytics on Spark DataFrames."""
