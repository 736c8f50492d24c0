"""Joins, ordering and reuse helpers that keep plans safe under skew."""
