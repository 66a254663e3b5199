"""Relational building blocks: keys, joins, aggregates, checks, change logs."""
