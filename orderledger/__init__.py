"""Batch analytics for orders and order items: clean, check, merge, report."""
