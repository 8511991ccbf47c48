"""Readers and writers of listings, page snapshots, results and external records."""
