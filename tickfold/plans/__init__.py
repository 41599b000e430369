"""Composed plans: silver hourly table, gold rollups, the full run."""
