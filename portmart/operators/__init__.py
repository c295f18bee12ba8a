"""Relational building blocks: cleaning, keys, profiles, checks, lookups, joins, pivots."""
