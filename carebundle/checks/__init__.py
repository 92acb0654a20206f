"""Queries over the driver's tables, and the same results as SQL for another engine."""
