"""A ledger of validations: a summary and a detail table, only ever appended to."""

from __future__ import annotations

import json
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType, TimestampType

from tidemark.quality.checks import BEFORE, CHECKS, Verdict, validate
from tidemark.store.files import Files

SUMMARY = StructType(
    [
        StructField("executed_at", TimestampType(), False),
        StructField("database", StringType()),
        StructField("table", StringType(), False),
        StructField("layer", StringType(), False),
        StructField("state", StringType()),
        StructField("reason", StringType()),
        StructField("ignored", StringType()),
    ]
)
DETAIL = StructType(
    [
        StructField("executed_at", TimestampType(), False),
        StructField("database", StringType()),
        StructField("table", StringType(), False),
        StructField("layer", StringType(), False),
        StructField("state", StringType()),
        StructField("check", StringType(), False),
        StructField("ignore", BooleanType(), False),
        StructField("detail", StringType()),
    ]
)


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self, kind: str = "summary") -> DataFrame:
        schema = SUMMARY if kind == "summary" else DETAIL
        path = f"{self.root}/{kind}"
        return self.spark.read.schema(schema).parquet(path) if Files(self.spark).exists(path) else self.spark.createDataFrame([], schema)

    def register(self, verdict: Verdict, database: str | None, table: str, layer: str, at: datetime, mode: str = "register") -> list[tuple]:
        """A summary row and a row for each check of the layer; with mode 'validate' nothing is written."""
        reason = ", ".join(name for name in verdict.failed if name not in verdict.ignored) or None
        summary = (at, database, table, layer, verdict.state, reason, ", ".join(verdict.ignored) or None)
        details = []
        for check in CHECKS[layer]:
            failed = check in verdict.failed
            detail = json.dumps(verdict.failed.get(check), ensure_ascii=False, default=str) if failed else None
            details.append((at, database, table, layer, "FAILED" if failed else "OK", check, check in verdict.ignored, detail))
        if mode == "register":
            self.spark.createDataFrame([summary], SUMMARY).coalesce(1).write.mode("append").parquet(f"{self.root}/summary")
            self.spark.createDataFrame(details, DETAIL).coalesce(1).write.mode("append").parquet(f"{self.root}/detail")
        elif mode != "validate":
            raise ValueError(f"mode {mode!r} is neither register nor validate")
        return [summary, *details]

    def last(self, table: str, layer: str, database: str | None = None) -> dict[str, Any] | None:
        """The newest summary row of a table in a layer."""
        rows = self.read().where((F.col("table") == table) & (F.col("layer") == layer))
        rows = rows.where(F.col("database") == database) if database else rows
        found = rows.orderBy(F.desc("executed_at")).limit(1).collect()
        return found[0].asDict() if found else None

    def validate(self, df: DataFrame, table: str, layer: str, column: str | None, as_of: str, database: str | None = None, **options: Any) -> Verdict:
        """validate() with what the ledger tells of the layer before; options go on to it."""
        before = self.last(table, BEFORE[layer], database) if layer in BEFORE else None
        return validate(df, table, layer, column, as_of, before=before, **options)

    def passed(self, table: str, layer: str) -> bool:
        """Whether the newest validation of the layer before let the table through; False without one."""
        row = self.last(table, layer)
        return row is not None and row["state"] == "OK"
