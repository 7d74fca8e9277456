"""Indicator marts on Spark: conform published series, upsert them, query them."""
