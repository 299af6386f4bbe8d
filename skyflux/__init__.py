"""Skyflux: PySpark-native processing of high-rate satellite-signal time series."""

__version__ = "0.1.0"
