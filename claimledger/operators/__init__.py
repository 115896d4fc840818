"""Joins, lookups and measures shared by the jobs."""
