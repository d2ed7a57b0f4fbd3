"""Operators Spark has no single call for."""
