"""Whole pipelines and the catalogue of queries with their SQL."""
