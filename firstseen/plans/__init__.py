"""Whole jobs: the daily run, publishing, reports, and the bound queries."""
