"""Page snapshots as a stream, merged into the feature table batch by batch."""
