"""DataFrame operators: grouping, illness counts, index, areas, geometry, QA, manifests."""
