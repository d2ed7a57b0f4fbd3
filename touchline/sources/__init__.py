"""Readers, sinks and the stored tables."""
