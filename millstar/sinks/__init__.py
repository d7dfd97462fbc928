"""Sinks: the sink interface and Parquet sink (S13), CSV (S11-S12), export."""
