"""Reusable table operators: dedup, key membership, ranking, sampling, lookup."""
