"""Staging models, quality scoring, marts and data tests."""
