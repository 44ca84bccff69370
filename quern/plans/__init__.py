"""Plan shapes shared by the operators: running totals, skewed joins, stage tables."""
