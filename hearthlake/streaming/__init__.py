"""Continuous forms of the loads and of the minute aggregates."""
