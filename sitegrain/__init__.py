"""sitegrain: website snapshots and listings into a clean entity table, and its analysis, on Spark."""
