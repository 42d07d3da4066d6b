"""Feature tables under a root: checked definitions, governed saving, a registry, lookups without leakage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import require
from tidemark.operators.joins import point_in_time_join
from tidemark.store.evolution import Policy, decide
from tidemark.store.files import Files
from tidemark.store.snapshots import SnapshotTable


@dataclass(frozen=True)
class FeatureTable:
    """A definition; all that is wrong with it is reported in one ValueError."""

    name: str
    description: str
    primary_keys: Sequence[str]
    timestamp_keys: Sequence[str]
    sources: Sequence[str] = ()
    tags: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        wrong = [f"{n} is blank" for n in ("name", "description") if not str(getattr(self, n) or "").strip()]
        for n in ("primary_keys", "timestamp_keys"):
            values = getattr(self, n)
            if not values or isinstance(values, str):
                wrong.append(f"{n} is not a list with items")
            elif any(not str(v or "").strip() for v in values):
                wrong.append(f"{n} has a blank item")
        if not wrong and (outside := [k for k in self.timestamp_keys if k not in self.primary_keys]):
            wrong.append(f"timestamp_keys {outside} aren't among the primary keys")
        if wrong:
            raise ValueError("; ".join(wrong))

    def config(self) -> dict[str, Any]:
        return {"description": self.description, "primary_keys": list(self.primary_keys), "timestamp_keys": list(self.timestamp_keys), "sources": list(self.sources), "tags": dict(self.tags)}


def can_read(df: DataFrame) -> str | None:
    """Why a row of df can't be read, or None. A table may be listed and yet be closed to the reader, or its files gone."""
    try:
        df.limit(1).collect()
    except Exception as error:  # whatever stands in the way, the caller is told of it
        return str(error).strip().splitlines()[0]
    return None


def check_sources(spark: SparkSession, sources: Sequence[str]) -> None:
    """Each source is db.table, exists, has columns and can be read; all failures in one ValueError."""
    wrong = []
    for source in sources:
        if source.count(".") != 1 or not all(source.split(".")):
            wrong.append(f"{source!r} isn't of the form db.table")
        elif not spark.catalog.databaseExists(source.split(".")[0]):
            wrong.append(f"there is no database {source.split('.')[0]!r}")
        elif not spark.catalog.tableExists(source):
            wrong.append(f"there is no table {source!r}")
        elif not spark.table(source).columns:
            wrong.append(f"{source!r} has no columns")
        elif reason := can_read(spark.table(source)):
            wrong.append(f"{source!r} can't be read: {reason}")
    if wrong:
        raise ValueError("; ".join(wrong))


class Registry:
    """Registered tables, a JSON file each, so that registrations of different tables never collide."""

    def __init__(self, spark: SparkSession, root: str):
        self._files, self.root = Files(spark), f"{root.rstrip('/')}/_registry"

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}.json"

    def names(self) -> list[str]:
        return [n[:-5] for n in self._files.names(self.root) if n.endswith(".json")]

    def get(self, name: str) -> dict[str, Any] | None:
        return self._files.read_json(self._path(name)) if self._files.exists(self._path(name)) else None

    def register(self, name: str, entry: Mapping[str, Any]) -> bool:
        """Create, or replace where anything changed, in one rename; False if nothing changed."""
        if self.get(name) == dict(entry):
            return False
        self._files.write_json(self._path(name), dict(entry))
        return True

    def drop(self, name: str) -> None:
        if self._files.exists(self._path(name)):
            self._files.delete(self._path(name))

    def sync(self, target: Registry, names: Sequence[str] | None = None) -> dict[str, dict[str, list[str]]]:
        """Copy entries to another root; tells for each changed one the sources that were added and removed."""
        changed = {}
        for name in names or self.names():
            entry, before = self.get(name), target.get(name) or {}
            if entry is None:
                raise LookupError(f"{name!r} isn't registered")
            if target.register(name, entry):
                old, new = set(before.get("sources", [])), set(entry.get("sources", []))
                changed[name] = {"added": sorted(new - old), "removed": sorted(old - new)}
        return changed


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.registry = Registry(spark, root)

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}")

    def save(self, definition: FeatureTable, df: DataFrame, mode: str = "insert_only", on_missing: Policy = "raise", force_overwrite: bool = False, files: int | None = None) -> dict[str, Any]:
        """Write the first version, or merge into the newest under the schema rules; then register.

        Columns that went are dealt with by on_missing; where it says 'overwrite', or with force_overwrite, df
        replaces the table. Rows that share a primary key are refused. Returns version, operation, warnings and
        whether the schema changed.
        """
        require(df, definition.primary_keys)
        stored = self.table(definition.name)
        diff = stored.diff(df)
        action = "overwrite" if force_overwrite or not stored.exists() else "merge"
        if diff.missing_columns and action == "merge" and decide(diff, on_missing) == "overwrite":
            action = "overwrite"
        if action == "overwrite":
            version = stored.overwrite(df, files=files, properties=definition.config(), unique=definition.primary_keys)
        else:
            version = stored.merge(df, definition.primary_keys, mode, definition.config())
        entry = {**definition.config(), "path": stored.path, "schema": stored.manifest()["schema"]}
        registered = self.registry.register(definition.name, entry)
        return {"version": version, "operation": action, "warnings": diff.warnings(), "schema_changed": bool(diff), "registered": registered}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.table(name).read(version)

    def lookup(self, labels: DataFrame, name: str, keys: Sequence[str], time: str, features: Sequence[str] | None = None, version: int | None = None, bucket: str | None = None) -> DataFrame:
        """labels with the newest features known at their time.

        bucket ('day', 'month', 'year') cuts each key's rows there, for keys with a large share of all rows.
        """
        entry = self.registry.get(name)
        if entry is None:
            raise LookupError(f"{name!r} isn't registered")
        stamp = entry["timestamp_keys"][0]
        right_keys = [k for k in entry["primary_keys"] if k != stamp]
        frame = self.read(name, version)
        chosen = list(features) if features else [c for c in frame.columns if c not in entry["primary_keys"]]
        return point_in_time_join(labels, frame, keys, time, chosen, right_keys, stamp, bucket=bucket)
