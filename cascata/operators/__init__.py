"""Row-set operators: ordered lookups, joins, waterfalls, pivots and checks."""
