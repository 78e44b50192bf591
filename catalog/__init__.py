"""Named queries on the driver tables, each with its SQL twin where SQL can say it."""

from importlib import import_module

SECTIONS = ("gold", "silver", "profile", "crop", "stats", "geo_text", "sources")


def load():
    """Import all sections and return the registry they filled."""
    for section in SECTIONS:
        import_module(f"catalog.{section}")
    return import_module("catalog.registry")
