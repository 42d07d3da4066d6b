"""Queries that save, merge, look up and check data, with results that SQL can state."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import steps
from tidemark.plans.operator_queries import orders
from tidemark.plans.registry import query, table
from tidemark.quality import checks
from tidemark.quality.ledger import Ledger
from tidemark.store.feature_store import FeatureStore, FeatureTable
from tidemark.store.snapshots import SnapshotTable
from tidemark.streaming.sinks import windowed_counts


def _root(spark: SparkSession) -> str:
    """A new folder where all executors can read and write."""
    conf = spark.sparkContext.getConf()
    shared = conf.get("spark.checkpoint.dir")
    if not shared:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "/tmp/checkpoints"
    path = f"{shared.rstrip('/')}/tidemark-store/{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def _half(spark: SparkSession, sf_dir: str, second: bool) -> DataFrame:
    """Orders before 1999, or from 1998 on with a changed price and a new column: 1998 is in both."""
    own = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")
    if not second:
        return own.where("o_orderdate < '1999-01-01'")
    return own.where("o_orderdate >= '1998-01-01'").select("o_orderkey", "o_orderdate", (F.col("o_totalprice") + 1).alias("o_totalprice"), (F.col("o_orderkey") % 9).alias("extra"))


@query("""SELECT o_orderkey, o_orderdate::date AS o_orderdate, CASE WHEN o_orderdate < DATE '1999-01-01' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderkey % 9 END AS extra FROM orders""")
def r07_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(_half(spark, sf_dir, False))
    stored.merge(_half(spark, sf_dir, True), ["o_orderkey"])
    return stored.read()


@query("""SELECT o_orderkey, o_orderdate::date AS o_orderdate, CASE WHEN o_orderdate < DATE '1998-01-01' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderkey % 9 END AS extra FROM orders""")
def r07_merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(_half(spark, sf_dir, False))
    stored.merge(_half(spark, sf_dir, True), ["o_orderkey"], "upsert")
    return stored.read()


@query("SELECT count(*) AS n, 3::bigint AS versions FROM orders WHERE o_orderdate < DATE '1999-01-01'")
def s05_time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(_half(spark, sf_dir, False))
    stored.merge(_half(spark, sf_dir, True), ["o_orderkey"])
    stored.compact(2)
    return stored.read(0).agg(F.count("*").alias("n")).withColumn("versions", F.lit(len(stored.versions())).cast("bigint"))


@query("SELECT o_orderstatus, count(*) AS n, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)::bigint AS replaced FROM orders GROUP BY 1")
def r12_replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    own = orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.lit(0).alias("flag"))
    stored.overwrite(own, ["o_orderstatus"])
    stored.replace_partitions(own.where("o_orderstatus = 'P'").withColumn("flag", F.lit(1)), "o_orderstatus")
    return stored.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("flag").alias("replaced"))


@query("SELECT 'NEW_COLUMNS' AS kind, 'extra' AS what UNION ALL SELECT 'MISSING_COLUMNS', 'o_orderdate' UNION ALL SELECT 'DATA_TYPE_CHANGED', 'o_totalprice'")
def r05_schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(_half(spark, sf_dir, False))
    diff = stored.diff(_half(spark, sf_dir, True).select("o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"), "extra"))
    rows = [("NEW_COLUMNS", c) for c in diff.new_columns] + [("MISSING_COLUMNS", c) for c in diff.missing_columns] + [("DATA_TYPE_CHANGED", c) for c in diff.changed_types]
    return spark.createDataFrame(rows, "kind string, what string")


@query("""WITH f AS (SELECT o_custkey AS c, date_trunc('month', o_orderdate)::date + INTERVAL 1 MONTH AS release, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate::date AS o_orderdate, f.n FROM orders o ASOF LEFT JOIN f ON o.o_custkey = f.c AND o.o_orderdate >= f.release""")
def r11_store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = FeatureStore(spark, _root(spark))
    own = orders(spark, sf_dir)
    release = F.add_months(F.trunc("o_orderdate", "month"), 1).alias("tpk_release_dt")
    store.save(FeatureTable("monthly", "orders of a month", ["pk_customer", "tpk_release_dt"], ["tpk_release_dt"]), own.groupBy(F.col("o_custkey").alias("pk_customer"), release).agg(F.count("*").alias("n")))
    return store.lookup(own.select("o_orderkey", "o_custkey", "o_orderdate"), "monthly", ["o_custkey"], "o_orderdate", ["n"])


@query("""WITH t AS (SELECT 'orders' AS "table", max(o_orderdate)::date AS last_date, 2 AS shift FROM orders UNION ALL SELECT 'lineitem', max(l_shipdate)::date, 0 FROM lineitem),
a AS (SELECT "table", last_date, (last_date + to_months(shift))::date AS available FROM t)
SELECT "table", last_date, available, available < DATE '2002-03-01' AS outdated, CASE WHEN available < DATE '2002-03-01' THEN datediff('month', available, DATE '2002-03-01') ELSE 0 END::int AS months_behind FROM a""")
def v01_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = checks.freshness(orders(spark, sf_dir), "orders", "o_orderdate", "2002-03-15", 2)
    return own.union(checks.freshness(table(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", "2002-03-15"))


@query("""WITH s AS (SELECT date_trunc('month', o_orderdate)::date AS month, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1),
t AS (SELECT date_trunc('month', o_orderdate)::date AS month, count(*) AS n FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderkey % 1000 <> 3 GROUP BY 1)
SELECT month, s.n AS source_n, t.n AS target_n, s.n - coalesce(t.n, 0) AS diff, abs(s.n - t.n) / nullif(t.n, 0) AS rel_diff FROM s FULL JOIN t USING (month) WHERE s.n <> coalesce(t.n, 0)""")
def v04_cross_check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return checks.cross_check_history(own, own.where("o_orderkey % 1000 != 3"), "o_orderdate", "1996-01-01")


@query("""WITH c AS (SELECT (SELECT count(*) FROM lineitem) AS source_n, (SELECT count(*) FROM lineitem WHERE l_linenumber <> 7) AS target_n),
d AS (SELECT *, abs(source_n - target_n) / nullif(target_n, 0) AS rel_diff FROM c) SELECT *, rel_diff <= 0.05 AS ok FROM d""")
def v05_cross_check_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return checks.cross_check_size(items, items.where("l_linenumber != 7"))


@query("SELECT 'orders' AS \"table\", 'ingestion' AS layer, 'FAILED' AS state, 'OUTDATENESS' AS reason")
def v08_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = Ledger(spark, _root(spark))
    own = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    for as_of, at in (("1999-01-15", 1), ("2009-01-15", 2)):
        verdict = checks.validate(own, "orders", "ingestion", "o_orderdate", as_of, own, ["o_orderkey"])
        ledger.register(verdict, None, "orders", "ingestion", datetime(2024, 1, at, tzinfo=UTC))
    row = ledger.last("orders", "ingestion")
    return spark.createDataFrame([(row["table"], row["layer"], row["state"], row["reason"])], "table string, layer string, state string, reason string")


@query("""SELECT l_suppkey, sum(l_quantity::decimal(18,2))::double AS qty, round((count(*) / nullif(count(DISTINCT l_orderkey), 0))::varchar::decimal(38,14), 4)::double AS n_to_orders_ratio FROM lineitem WHERE l_tax > 0.02 GROUP BY 1""")
def o02_step_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = [{"operation": "count", "alias": "n"}, {"operation": "count_distinct", "column": "l_orderkey", "alias": "orders"}, {"operation": "sum", "column": "q", "alias": "qty"}]
    plan = [
        {"step": "filter_by_conditions", "params": {"conditions": ["l_tax > 0.02"]}},
        {"step": "binarize", "params": {"columns": {"q": "cast(l_quantity as decimal(18,2))"}}},
        {"step": "aggregation_operations", "params": {"by_columns": ["l_suppkey"], "operations": ops}},
        {"step": "binarize", "params": {"columns": {"qty": "cast(qty as double)"}}},
        {"step": "ratios", "params": {"pairs": [["n", "orders"]]}},
        {"step": "select_columns", "params": {"columns": ["l_suppkey", "qty", "n_to_orders_ratio"]}},
    ]
    return steps.run(table(spark, sf_dir, "lineitem"), plan)


@query("SELECT date_trunc('day', ts)::date AS day, event_type, count(*) AS n, sum(value::decimal(18,4))::double AS value_sum FROM events GROUP BY 1, 2")
def st1_windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windowed_counts(table(spark, sf_dir, "events"), "ts", ["event_type"], value="value").select(F.to_date("window_start").alias("day"), "event_type", "n", "value_sum")
