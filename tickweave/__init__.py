"""Tick analytics on Spark: normalise, store, check and query trade ticks."""

__version__ = "0.1.0"
