"""Named queries over the star-schema tables."""

from importlib import import_module

from meterspan.plans import registry

MODULES = ["energy", "series", "statistics", "vectors", "incidents", "bills", "scenarios", "models", "streams"]


def load():
    """All queries by name, and the SQL of those that have one."""
    for name in MODULES:
        import_module(f"meterspan.plans.{name}")
    return dict(registry.QUERIES), dict(registry.SQL)
