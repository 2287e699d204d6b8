"""Footfall analytics on Spark: people counts per sensor, hour and day."""
