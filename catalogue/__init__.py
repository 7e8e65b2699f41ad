"""Registered queries: every operator over loan tables derived from the given tables."""
