"""Registered queries with their SQL oracles, over the benchmark tables."""
