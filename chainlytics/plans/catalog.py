"""Tables, rollups and policies declared as data, and applied in that order."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path

from pyspark.sql import SparkSession

from chainlytics import storage
from chainlytics.plans import rollup_store, tables
from chainlytics.plans.rollup_store import Policy, Rollup
from chainlytics.plans.tables import KeyedTable
from chainlytics.schemas import COLUMN_TYPES, struct


@dataclass
class Catalog:
    root: str
    tables: dict[str, KeyedTable] = field(default_factory=dict)
    rollups: dict[str, Rollup] = field(default_factory=dict)
    policies: dict[str, Policy] = field(default_factory=dict)
    aliases: dict[str, str] = field(default_factory=dict)

    def rollup(self, name: str) -> Rollup:
        return self.rollups[self.aliases.get(name, name)]


def definitions(*more: str) -> dict:
    """Fixed values, names and offsets that must be as they are in ``definitions.json``: the block table, its three daily rollups
    and their refresh policies. ``more`` names further groups of it: ``cascade`` has hours, days of hours and weeks of days."""
    defs = json.loads(Path(__file__).with_name("definitions.json").read_text())
    groups = defs.pop("more")
    for group in more:
        for kind, entries in groups[group].items():
            defs[kind] += entries
    return defs


def build(root: str, defs: Mapping | None = None) -> Catalog:
    """Definitions -> objects, rollups in the order of their dependencies; nothing is written."""
    defs = definitions() if defs is None else defs
    catalog = Catalog(root)
    for t in defs["tables"]:
        schema = struct(**{name: COLUMN_TYPES[kind] for name, kind in t["columns"].items()})
        catalog.tables[t["name"]] = KeyedTable.by_time(
            f"{root}/{t['name']}", schema, t["unique"], t["time"], partial=t.get("partial", ())
        )
    times = {t["name"]: t["time"] for t in defs["tables"]}
    waiting = list(defs["rollups"])
    while waiting:  # bases before what is built on them
        ready = [r for r in waiting if r["base"] in catalog.tables or r["base"] in catalog.rollups]
        if not ready:
            raise ValueError(f"rollups on unknown bases: {sorted(r['name'] for r in waiting)}")
        for r in ready:
            base = catalog.tables.get(r["base"]) or catalog.rollups[r["base"]]
            catalog.rollups[r["name"]] = Rollup(
                r["name"], base, times.get(r["base"], "time"), r["width"], r["measures"], f"{root}/{r['name']}"
            )
            catalog.aliases.update({alias: r["name"] for alias in r.get("aliases", [])})
        waiting = [r for r in waiting if r not in ready]
    for p in defs["policies"]:
        catalog.policies[p["rollup"]] = Policy(**p)
    return catalog


def apply(spark: SparkSession, root: str, defs: Mapping | None = None) -> Catalog:
    """Create what does not exist yet: tables, then rollup stores; policies are checked last."""
    catalog = build(root, defs)
    for table in catalog.tables.values():
        tables.create(spark, table)
    for rollup in catalog.rollups.values():
        tables.create(spark, rollup.store(spark))
    unknown = set(catalog.policies) - set(catalog.rollups)
    if unknown:
        raise ValueError(f"policies for unknown rollups: {sorted(unknown)}")
    return catalog


def refresh(spark: SparkSession, catalog: Catalog, now: datetime) -> None:
    """Run all refresh policies, those of a rollup after those of its base."""
    for name, rollup in catalog.rollups.items():
        if name in catalog.policies:
            rollup_store.run_policy(spark, rollup, catalog.policies[name], now)


def register_views(spark: SparkSession, catalog: Catalog) -> None:
    """Make tables and real-time rollups, with their aliases, queryable by name.

    A rollup view holds the mark of this moment: register again after a refresh to move the
    boundary. Rows are right either way, as everything from the mark on is computed live."""
    for name, table in catalog.tables.items():
        # With the slice column, so that panels and readers can filter on it.
        tables.read_slices(spark, table).createOrReplaceTempView(name)
    for name in [*catalog.rollups, *catalog.aliases]:
        rollup_store.read(spark, catalog.rollup(name)).createOrReplaceTempView(name)


def drop_table(spark: SparkSession, catalog: Catalog, name: str) -> None:
    """Drop a table together with the rollups built on it, directly or over others, their policies and views."""
    table = catalog.tables.pop(name)
    for rollup in [r for r in reversed(catalog.rollups.values()) if r.table is table]:
        rollup_store.drop(spark, rollup)
        del catalog.rollups[rollup.name]
        catalog.policies.pop(rollup.name, None)
        spark.catalog.dropTempView(rollup.name)
        for alias in [a for a, target in catalog.aliases.items() if target == rollup.name]:
            del catalog.aliases[alias]
            spark.catalog.dropTempView(alias)
    spark.catalog.dropTempView(name)
    storage.drop(spark, table.path)
