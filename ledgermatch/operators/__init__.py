"""Relational building blocks: filters, joins, aggregates, set operations."""
