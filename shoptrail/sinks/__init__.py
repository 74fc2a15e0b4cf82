"""Sinks: Parquet routes, store fan-out, warehouse-ready shaping, retention."""
