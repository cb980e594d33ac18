"""Importing this package registers every query."""

from importlib import import_module

for _name in ("sources", "maintenance", "filters", "joins", "aggregates", "windows", "ranking", "columns",
              "search", "streams", "jobs"):
    import_module(f"{__name__}.{_name}")
