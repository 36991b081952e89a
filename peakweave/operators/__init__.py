"""DataFrame operators: ordering, joins, pooling and single-cell preparation."""
