"""Spark jobs for ingesting, staging and auditing large text corpora."""
