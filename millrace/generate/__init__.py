"""Deterministic, distributed generation of retail and event tables."""
