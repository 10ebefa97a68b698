"""Named queries over the driver tables, with the SQL that checks them."""

from __future__ import annotations

import importlib

MODULES = ("spatial_queries", "decision_queries", "surface_queries", "overlay_queries", "chain_queries")


def _modules():
    return [importlib.import_module(f"gablestone.plans.{m}") for m in MODULES]


def flagship(spark, sf_dir):
    return queries()["a02_building_summary"](spark, sf_dir)


def queries():
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in _modules() for k, s in m.ORACLES.items()}
