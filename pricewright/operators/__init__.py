"""DataFrame operators: filters, joins, aggregates, windows, encoders, models."""
