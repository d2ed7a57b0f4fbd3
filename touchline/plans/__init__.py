"""Layers, marts, reports and the queries over the given tables."""
