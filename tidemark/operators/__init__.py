"""Row-set operators: alignment, dedup, relations, quality, merges, history, drift, paging."""
