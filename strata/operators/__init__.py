"""Reusable DataFrame operators: dedup policies, joins, data-quality checks."""
