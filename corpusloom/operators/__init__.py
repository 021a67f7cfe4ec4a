"""Reusable DataFrame operators: chunks, dedup, exact medians, totals."""
