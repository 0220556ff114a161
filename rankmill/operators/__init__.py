"""Reusable DataFrame operators: snapshots, dedup, ranking, checks, profiles."""
