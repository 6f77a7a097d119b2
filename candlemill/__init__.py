"""Minute-candle analytics on Spark: every operator is DataFrame -> DataFrame."""
