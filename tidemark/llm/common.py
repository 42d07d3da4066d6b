"""Shared pieces: shared-folder tables, small Arrow batches, tables of a test directory."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from weakref import WeakSet

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of cells that a worker gathers before it hands a batch back to the JVM.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where it is unset, a local folder, and then only for a local master."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir")
    if not root:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "/tmp/checkpoints"
    return f"{root.rstrip('/')}/tidemark"


_SENT: WeakSet[SparkContext] = WeakSet()


def _send_code(context: SparkContext) -> None:
    """Hand this package to the Python workers, which needn't have it on their path."""
    if context in _SENT:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "tidemark_code.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SENT.add(context)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    _send_code(df.sparkSession.sparkContext)
    return df.mapInArrow(function, schema)


class Scratch:
    """Tables in the shared folder that cut lineage.

    They are written as Parquet, so a lost executor costs no recomputation of what lies before them, and are
    removed by drop() or, at the latest, when the JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{uuid.uuid4().hex}"
        self._count = 0
        #: Each table with its path; holding the tables keeps their ids from being given to others.
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def keep(self, df: DataFrame, codec: str = "zstd") -> DataFrame:
        """Write df and read it back."""
        if not self._count:
            fs, path = self._fs(self.root)
            fs.deleteOnExit(path)
        self._count += 1
        path = f"{self.root}/{self._count}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = out, path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove tables that no later plan reads, and let go of plans that Python holds in cycles, and so their shuffles."""
        gc.collect()
        for df in frames:
            if kept := self._paths.pop(id(df), None):
                fs, hadoop = self._fs(kept[1])
                fs.delete(hadoop, True)


    def drop_all_but(self, *frames: DataFrame) -> None:
        """Remove all other tables."""
        kept = {id(df) for df in frames}
        self.drop(*(df for key, (df, _) in list(self._paths.items()) if key not in kept))


def whole_row(docs: DataFrame) -> Column:
    """All columns of docs in one, `row`, beside which any names are free."""
    return F.struct(*(F.col(f"`{name.replace('`', '``')}`") for name in docs.columns)).alias("row")


def in_batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows to Arrow batches of about BATCH_BYTES of strings and bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(cell) for cell in row if isinstance(cell, str | bytes))
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)], schema=schema)


def cells(batch: pa.RecordBatch, *names: str, step: int = 256) -> Iterator[tuple]:
    """Tuples of the named columns, a few hundred rows at a time as Python objects."""
    picked = batch.select(list(names))
    for at in range(0, picked.num_rows, step):
        part = picked.slice(at, step)
        yield from zip(*(column.to_pylist() for column in part.columns))


def apart(grouped: DataFrame) -> DataFrame:
    """A grouped table dealt anew, for a join with rows of the groups it was made from.

    Joined as it is, it would fix where those rows have to be, so a hot group would stay in one task; dealt anew, both
    sides of the join are plain shuffles, which Spark splits where a partition is skewed.
    """
    return grouped.hint("rebalance")
