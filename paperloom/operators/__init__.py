"""DataFrame to DataFrame operators: ranking, merging, linkage, quality."""
