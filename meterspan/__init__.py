"""Household energy analytics as Spark DataFrame jobs, keyed by household."""

__all__ = ["fixed", "schemas", "session"]
