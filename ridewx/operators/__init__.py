"""DataFrame → DataFrame operators: expectations, joins, aggregates, statistics."""
