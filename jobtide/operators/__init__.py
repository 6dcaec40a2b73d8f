"""Reusable DataFrame operators: dedupe, reshape, joins, aggregates, set operations."""
