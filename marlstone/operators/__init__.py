"""DataFrame operators: joins, aggregates, windows, sets, quality rules, assertions and publication."""
