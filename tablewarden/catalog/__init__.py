"""Queries over the given tables, one per operator, with SQL to check them."""

import importlib

MODULES = ("data", "features", "preparation", "evaluation", "drift", "traffic", "alerting", "modelling")


def load() -> None:
    for name in MODULES:
        importlib.import_module(f"tablewarden.catalog.{name}")
