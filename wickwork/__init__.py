"""Wickwork: candle (OHLCV) analytics on Spark DataFrames."""
