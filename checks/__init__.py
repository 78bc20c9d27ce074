"""Registered queries: every operator on the given tables, with its SQL twin."""

import importlib

MODULES = ("q_windows", "q_merge", "q_screen", "q_reconcile", "q_catalog", "q_sources", "q_scalars", "q_products", "q_series")


def load():
    from checks import base
    for m in MODULES:
        try:
            importlib.import_module(f"checks.{m}")
        except ModuleNotFoundError as e:
            if f"checks.{m}" not in str(e):
                raise
    return base.QUERIES, base.ORACLE
