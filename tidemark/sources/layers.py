"""Datasets in layers: a catalog table or a folder of files for `source`, folders below a root for the others."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

if TYPE_CHECKING:
    import pandas as pd


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in whatever file system it names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


class Layers:
    """config: {dataset: {"source": table or path, "<layer>_path": path}}."""

    def __init__(self, spark: SparkSession, config: Mapping[str, Mapping[str, str]]):
        self.spark, self.config = spark, config

    def read(self, dataset: str, layer: str = "source", fmt: str | None = None, schema: StructType | None = None) -> DataFrame:
        """A source by table name or, if it has a slash, as a folder of Parquet files (or fmt); another layer by fmt."""
        place = self.config[dataset]["source" if layer == "source" else f"{layer}_path"]
        if layer == "source" and "/" not in place:
            return self.spark.table(place)
        if layer != "source" and not fmt:
            raise ValueError(f"layer {layer!r} needs a format")
        reader = self.spark.read.format(fmt or "parquet")
        return (reader.schema(schema) if schema else reader).load(place)

    def exists(self, dataset: str, layer: str) -> bool:
        place = self.config[dataset]["source" if layer == "source" else f"{layer}_path"]
        return self.spark.catalog.tableExists(place) if "/" not in place else path_exists(self.spark, place)


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: StructType | str | None = None) -> DataFrame:
    """A frame that the driver already holds, sent through Arrow; its missing values become NULL."""
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None) if schema else frame, schema)


_TABLE_NAME = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)?")


def save_table(df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> DataFrame:
    """df as a catalog table (table or db.table), at a path if one is given, and that table as read back."""
    if not _TABLE_NAME.fullmatch(name):
        raise ValueError(f"{name!r} isn't a table's name")
    writer = df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)
    writer.saveAsTable(name, format="parquet", path=path)
    return df.sparkSession.table(name)


def sql_with_views(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A query over frames under temporary view names; the views are gone afterwards, the result keeps its plan."""
    try:
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
        return spark.sql(text)
    finally:
        for name in frames:
            spark.catalog.dropTempView(name)


def select_datasets(config: Mapping, wanted: list[str] | str | None = None, omit: list[str] | None = None) -> list[str]:
    """Names of datasets in the order of the config; nothing, or '*', means all."""
    names = list(config) if not wanted or wanted in ("*", ["*"]) else [wanted] if isinstance(wanted, str) else list(wanted)
    if unknown := [n for n in names if n not in config]:
        raise KeyError(f"no such datasets: {unknown}")
    return [n for n in config if n in names and n not in (omit or [])]
