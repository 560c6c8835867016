"""Runs and model versions kept as tables."""
