"""DataFrame operators: features, entity resolution, joins, merges, quality analysis, differences, link frontiers."""
