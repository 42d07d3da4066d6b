"""Versioned tables: each commit adds a folder of Parquet files and a manifest; readers resolve a version first.

A manifest names the folders (batches) that hold a version, each as a whole or by its files that still count. An
append adds a batch; a merge or a replaced partition adds one and leaves out the files that it rewrote, so what a
commit reads and writes follows from what it changes, not from the size of the table.

No file that may be read is ever overwritten. A commit is the creation of its manifest by a rename, so of two
writers of one version one fails. Old versions stay until vacuum(), which gives time travel.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import as_list, require
from tidemark.store.evolution import SchemaDiff, compare
from tidemark.store.files import Files

#: The folder level above each batch; no column may have this name.
_BATCH = "batch__"


class ConcurrentCommitError(RuntimeError):
    """Another writer committed the version first."""


class DuplicateKeysError(ValueError):
    """Rows to merge share a key."""


#: Batches by name: None for all files, or the relative paths of those that count.
Batches = dict[str, list[str] | None]


class SnapshotTable:
    """A table below a path: data/batch__=<id> folders, _manifests/v<n>.json and _properties/v<n>.json."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._files = spark, path.rstrip("/"), Files(spark)

    # --- versions ---

    def versions(self) -> list[int]:
        names = self._files.names(f"{self.path}/_manifests")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> dict[str, Any]:
        known = self.versions()
        if not known or version is not None and version not in known:
            raise LookupError(f"{self.path} has no version {version if known else 'at all'}")
        version = known[-1] if version is None else version
        manifest = self._files.read_json(f"{self.path}/_manifests/v{version}.json")
        if self._files.exists(beside := f"{self.path}/_properties/v{version}.json"):
            manifest["properties"].update(self._files.read_json(beside))
        return manifest

    def history(self) -> list[dict[str, Any]]:
        return [self.manifest(v) for v in self.versions()]

    def version_as_of(self, when: datetime) -> int:
        """The newest version committed before the time, else the newest of all."""
        before = [m["version"] for m in self.history() if datetime.fromisoformat(m["committed"]) < when]
        return before[-1] if before else self.versions()[-1]

    def schema(self) -> StructType | None:
        return StructType.fromJson(json.loads(self.manifest()["schema"])) if self.exists() else None

    def diff(self, df: DataFrame) -> SchemaDiff:
        return compare(self.schema(), df.schema)

    # --- reading ---

    def _folder(self, batch: str) -> str:
        return f"{self.path}/data/{_BATCH}={batch}"

    def _read(self, batches: Batches, schema: StructType) -> DataFrame:
        """The rows of batches; files from before a column was added give NULL for it."""
        paths = [p for batch, files in batches.items() for p in ([self._folder(batch)] if files is None else [f"{self._folder(batch)}/{f}" for f in files])]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.manifest(version)
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        return self._read(manifest["batches"], schema).select(*schema.names)

    # --- writing ---

    def _write(self, df: DataFrame, partition_by: Sequence[str], files: int | None = None) -> str | None:
        """A new batch; None where df has no rows and so no files."""
        if _BATCH in df.columns:
            raise ValueError(f"{_BATCH!r} can't be a column")
        batch = uuid.uuid4().hex
        writer = (df.repartition(files) if files else df).write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(self._folder(batch))
        return batch if self._files.below(self._folder(batch), limit=1) else None

    def _commit(self, batch: str | None, others: Batches, schema: StructType, operation: str, partition_by: Sequence[str], properties: Mapping[str, Any] | None, before: Mapping[str, Any] | None) -> int:
        version = before["version"] + 1 if before else 0
        manifest = {
            "version": version,
            "batches": {**others, **({batch: None} if batch else {})},
            "schema": schema.json(),
            "operation": operation,
            "partition_by": list(partition_by),
            "committed": datetime.now(UTC).isoformat(),
            "properties": {**(before["properties"] if before else {}), **(properties or {})},
        }
        if not self._files.write_json(f"{self.path}/_manifests/v{version}.json", manifest, new=True):
            if batch:
                self._files.delete(self._folder(batch))
            raise ConcurrentCommitError(f"version {version} of {self.path} exists")
        return version

    def overwrite(
        self, df: DataFrame, partition_by: Sequence[str] = (), files: int | None = None, properties: Mapping[str, Any] | None = None, operation: str = "overwrite", unique: Sequence[str] = ()
    ) -> int:
        """The rows of df alone; with unique, a DuplicateKeysError where two of them share these keys, before they count."""
        before = self.manifest() if self.exists() else None
        batch = self._write(df, partition_by, files)
        if batch and unique:
            try:
                _require_unique(self._read({batch: None}, df.schema), unique)
            except DuplicateKeysError:
                self._files.delete(self._folder(batch))
                raise
        return self._commit(batch, {}, df.schema, operation, partition_by, properties, before)

    def _add(self, df: DataFrame, operation: str, before: Mapping[str, Any], properties: Mapping[str, Any] | None = None) -> int:
        """The rows of df as one more batch after a version; columns that it lacks are NULL, new ones are added, known ones keep their type."""
        stored = StructType.fromJson(json.loads(before["schema"]))
        schema = _widened(stored, df.schema)
        own = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return self._commit(self._write(df.select(*own), before["partition_by"]), before["batches"], schema, operation, before["partition_by"], properties, before)

    def append(self, df: DataFrame) -> int:
        return self._add(df, "append", self.manifest()) if self.exists() else self.overwrite(df)

    @contextmanager
    def _staged(self, df: DataFrame):
        """df written once and read back, as what follows looks at it more than once."""
        path = f"{self.path}/_staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            self._files.delete(path)

    def _touched(self, manifest: Mapping[str, Any], schema: StructType, values: DataFrame, columns: Sequence[str]) -> tuple[Batches, Batches]:
        """Batches in files with a row whose columns are among values, and in those without.

        The driver gets a name for each such file, never rows.
        """
        rows = self._read(manifest["batches"], schema).select(*columns, _BATCH, F.col("_metadata.file_path").alias("file__")) if manifest["batches"] else None
        found: dict[str, set[str]] = {}
        if rows is not None:
            for row in rows.join(values.select(*columns), list(columns), "left_semi").select(_BATCH, "file__").distinct().collect():
                found.setdefault(row[_BATCH], set()).add(self._files.decoded(row["file__"]).partition(f"{_BATCH}={row[_BATCH]}/")[2])
        rest: Batches = {}
        for batch, files in manifest["batches"].items():
            if batch not in found:
                rest[batch] = files
            elif kept := sorted(set(self._files.below(self._folder(batch)) if files is None else files) - found[batch]):
                rest[batch] = kept
        return {batch: sorted(files) for batch, files in found.items()}, rest

    def merge(self, df: DataFrame, keys: Sequence[str], mode: str = "insert_only", properties: Mapping[str, Any] | None = None) -> int:
        """Rows with new keys are added. For known keys insert_only keeps stored values and fills columns that are new,
        upsert takes the new row. Columns that df lacks stay, or are NULL for added rows.

        A null key matches no other. Rows of df that share a key are a DuplicateKeysError, and nothing is written.
        Only files that hold a key of df are rewritten; where nothing stored changes, none are.
        """
        keys = as_list(keys)
        require(df, keys)
        if mode not in ("insert_only", "upsert"):
            raise ValueError(f"mode {mode!r} is neither insert_only nor upsert")
        manifest = self.manifest()
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        require(self._read({}, schema), keys)
        with self._staged(df) as fresh:
            _require_unique(fresh, keys)
            if mode == "insert_only" and set(df.columns) <= set(schema.names):
                return self._add(fresh.join(self.read(manifest["version"]).select(*keys), keys, "left_anti").select(*df.columns), f"merge:{mode}", manifest, properties)
            touched, rest = self._touched(manifest, schema, fresh, keys)
            merged, wide = _merged(self._read(touched, schema).select(*schema.names), fresh, keys, mode), _widened(schema, df.schema)
            return self._commit(self._write(merged, manifest["partition_by"]), rest, wide, f"merge:{mode}", manifest["partition_by"], properties, manifest)

    def replace_partitions(self, df: DataFrame, column: str) -> int:
        """Rows of the column's values in df take the place of all stored rows with those values.

        Where the table is partitioned by the column no stored row is read; a table that isn't becomes so, as a whole.
        """
        require(df, [column])
        if not self.exists():
            return self.overwrite(df, [column])
        manifest = self.manifest()
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        with self._staged(df) as fresh:
            values = fresh.select(column).distinct()
            if manifest["partition_by"] != [column]:
                kept = self.read(manifest["version"]).join(values, column, "left_anti")
                return self.overwrite(kept.unionByName(fresh, allowMissingColumns=True), [column], operation=f"replace:{column}")
            _, rest = self._touched(manifest, schema, values, [column])
            wide = _widened(schema, df.schema)
            own = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wide]
            return self._commit(self._write(fresh.select(*own), [column]), rest, wide, f"replace:{column}", [column], None, manifest)

    def insert_unseen(self, df: DataFrame, column: str) -> int:
        """Only rows whose value of the column isn't stored yet are added."""
        require(df, [column])
        if not self.exists():
            return self.overwrite(df, [column])
        manifest = self.manifest()
        known = self.read(manifest["version"]).select(column).distinct()
        return self._add(df.join(known, column, "left_anti").select(*df.columns), f"insert_unseen:{column}", manifest)

    def compact(self, files: int) -> int:
        """The newest version's rows in so many files."""
        return self.overwrite(self.read(), self.manifest()["partition_by"], files, operation="compact")

    def set_properties(self, properties: Mapping[str, Any]) -> dict[str, Any]:
        """Changed properties only, in a file beside the newest version's manifest; returns those that changed."""
        manifest = self.manifest()
        changed = {k: v for k, v in properties.items() if manifest["properties"].get(k) != v}
        if changed:
            self._files.write_json(f"{self.path}/_properties/v{manifest['version']}.json", {**manifest["properties"], **changed})
        return changed

    def vacuum(self, keep: int = 1) -> list[int]:
        """Removes all but the newest versions, and the files that only these held; returns their numbers."""
        versions = self.versions()
        gone = versions[:-keep] if keep else []
        held: dict[str, set[str] | None] = {}
        for version in versions[len(gone) :]:
            for batch, files in self.manifest(version)["batches"].items():
                held[batch] = None if files is None or held.get(batch, set()) is None else held.get(batch, set()) | set(files)
        for version in gone:
            manifest = self.manifest(version)
            self._files.delete(f"{self.path}/_manifests/v{version}.json")
            self._files.delete(f"{self.path}/_properties/v{version}.json")
            for batch in manifest["batches"]:
                if batch not in held:
                    self._files.delete(self._folder(batch))
                elif held[batch] is not None:
                    self._drop(batch, set(self._files.below(self._folder(batch))) - held[batch])
        return gone

    def _drop(self, batch: str, files: Iterable[str]) -> None:
        for name in files:
            self._files.delete(f"{self._folder(batch)}/{name}")


def _require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """DuplicateKeysError where rows share keys; a null key is like no other."""
    told_apart = reduce(and_, (F.col(k).isNotNull() for k in keys))
    if twice := df.where(told_apart).groupBy(*keys).agg(F.count("*").alias("n__")).where("n__ > 1").limit(1).collect():
        raise DuplicateKeysError(f"{twice[0]['n__']} rows share the key {tuple(twice[0][k] for k in keys)}")


def _widened(stored: StructType, fresh: StructType) -> StructType:
    """The stored columns, then the new ones; all may be NULL."""
    return StructType([*stored.fields, *(f for f in fresh.fields if f.name not in stored.names)])


def _merged(stored: DataFrame, fresh: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """A full outer join by the keys; which side a column comes from follows from mode and from who has it."""
    here = stored.select(*(F.col(c).alias(f"__s_{c}") for c in stored.columns), F.lit(True).alias("__stored"))
    there = fresh.select(*(F.col(c).alias(f"__n_{c}") for c in fresh.columns), F.lit(True).alias("__new"))
    joined = here.join(there, [F.col(f"__s_{k}") == F.col(f"__n_{k}") for k in keys], "full")
    is_known, is_fresh = F.coalesce("__stored", F.lit(False)), F.coalesce("__new", F.lit(False))

    def value(c: str):
        old = F.col(f"__s_{c}") if c in stored.columns else None
        new = F.col(f"__n_{c}") if c in fresh.columns else None
        if old is None:
            return new
        if new is None:
            return old
        keeps_old = is_known & ~is_fresh if mode == "upsert" else is_known
        return F.when(keeps_old, old).otherwise(new.cast(stored.schema[c].dataType))

    return joined.select(*(value(c).alias(c) for c in [*stored.columns, *(c for c in fresh.columns if c not in stored.columns)]))
