"""Tallgrass: market-intelligence analytics as declarative Spark plans."""
