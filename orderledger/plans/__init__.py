"""Whole jobs: load a batch, write the daily report."""
