"""Continuous form of the bronze load."""
