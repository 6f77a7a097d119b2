"""Operators over candle DataFrames."""
