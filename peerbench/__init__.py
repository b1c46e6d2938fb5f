"""Peer benchmarking of entities on Spark: clean, score, query, segment and watch."""
