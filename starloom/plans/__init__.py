"""Whole plans: silver dimensions, silver scans, gold star, measures, the full run."""
