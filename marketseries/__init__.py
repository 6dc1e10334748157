"""Spark operators for panels of market data and for long time series."""
