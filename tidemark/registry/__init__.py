"""All registered queries; importing the modules fills the two dictionaries."""

from importlib import import_module

from tidemark.registry.base import ORACLES, QUERIES

MODULES = ("retail", "sales", "basics", "cleaning", "calls", "files", "functions")

for _name in MODULES:
    import_module(f"tidemark.registry.{_name}")

__all__ = ["ORACLES", "QUERIES"]
