"""Queries for the operators that the other modules use only as parts."""

from __future__ import annotations

import re
import uuid
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.operators import aggregation, cleaning, dates, filters, joins, projection, windows
from tidemark.plans import features, jobs, steps
from tidemark.plans.feature_queries import months_between_sql, rounded
from tidemark.plans.operator_queries import orders
from tidemark.plans.registry import query, table
from tidemark.plans.store_queries import _root
from tidemark.quality import checks
from tidemark.quality.ledger import Ledger
from tidemark.sources import star
from tidemark.sources.layers import Layers, from_pandas, from_rows, path_exists, save_table, select_datasets
from tidemark.store.feature_store import FeatureStore, FeatureTable, check_sources
from tidemark.store.files import Files
from tidemark.store.snapshots import SnapshotTable


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def s02_layered_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _root(spark)
    table(spark, sf_dir, "nation").write.parquet(f"{root}/ingestion")
    layers = Layers(spark, {"nation": {"source": f"{sf_dir}/nation.parquet", "ingestion_path": f"{root}/ingestion"}})
    return layers.read("nation", "ingestion", "parquet").join(layers.read("nation"), ["n_nationkey", "n_name", "n_regionkey"], "left_semi")


@query("SELECT unnest(['there', 'elsewhere', 'a table']) AS place, unnest([true, false, false]) AS found")
def s03_path_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(spark, {"t": {"source": "default.tidemark_nothing"}})
    rows = [("there", path_exists(spark, f"{sf_dir}/nation.parquet")), ("elsewhere", path_exists(spark, f"{_root(spark)}/none")), ("a table", layers.exists("t", "source"))]
    return from_rows(spark, rows, "place string, found boolean")


@query("SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY 1")
def s04_partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(orders(spark, sf_dir).select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])
    return stored.read().groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("SELECT 1 AS k, 'a' AS s UNION ALL SELECT 2, NULL")
def s06_rows_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_rows(spark, [(1, "a"), (2, None)], "k int, s string")


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS name, n_nationkey * 0.5::double AS half FROM nation")
def s07_pandas_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "nation").toPandas()  # a generator's frame: a few rows that the driver holds
    frame = frame.assign(half=frame["n_nationkey"] * 0.5, name=frame["n_name"].where(frame["n_nationkey"] % 4 != 0, None))[["n_nationkey", "name", "half"]]
    saved = from_pandas(spark, frame, "k int, name string, half double")
    return save_table(saved, f"tidemark_{uuid.uuid4().hex}", f"{_root(spark)}/table")


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 'superior' WHEN 'HOUSEHOLD' THEN 'superior' WHEN 'BUILDING' THEN 'building' ELSE 'ninguna' END AS lvl1, lower(c_mktsegment) AS lvl2 FROM customer")
def p15_category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.normalize_strings(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("lvl2")))
    return projection.roll_up(clean, "lvl2", "lvl1", {"superior": ["furniture", "household"]}, ["building"], "ninguna")


@query("SELECT c_custkey, count(o_orderkey) AS n, coalesce(sum(o_totalprice::decimal(18,2)), 0)::double AS amount FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def c05_fill_after_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.sum(star.money("o_totalprice")).cast("double").alias("amount"))
    return cleaning.impute(joins.make_join(table(spark, sf_dir, "customer").select("c_custkey"), sums, "left", "c_custkey", "c_custkey"), 0)


@query("SELECT n_nationkey, replace(lower(n_name), ' ', '_') AS n_name FROM nation")
def c10_prepare_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("  ("), "n_name", F.lit(") - ?")).alias("n_name"))
    return cleaning.normalize_strings(raw)


@query("""SELECT o_custkey, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice::decimal(18,2) ELSE 0 END)::double AS urgent_total, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) > 0 AS ind_urgent_o_orderpriority,
sum(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice::decimal(18,2) ELSE 0 END)::double AS low_total, sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) > 0 AS ind_low_o_orderpriority, count(o_orderkey) AS o_orderkey_count_m FROM orders GROUP BY 1""")
def a03_explicit_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).withColumn("o_totalprice", star.money("o_totalprice"))
    wide = aggregation.pivot_panel(rows, ["o_custkey"], {"o_orderkey": ["count"]}, "o_orderpriority", {"o_totalprice": "total"}, {"1-URGENT": "urgent", "5-LOW": "low"})
    return wide.withColumns({c: F.col(c).cast("double") for c in ("urgent_total", "low_total")})


@query("SELECT l_orderkey, count(*) AS lines, sum(l_linenumber)::bigint AS l_linenumber_sum, max(l_shipdate)::date AS l_shipdate FROM lineitem GROUP BY 1")
def a04_basic_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"))
    return aggregation.panel(items, ["l_orderkey"], ["l_linenumber"], ["l_shipdate"], "lines")


@query("SELECT max(o_orderdate)::date AS last, min(o_orderdate)::date AS first, count(*) AS n, sum(abs(o_orderkey % 11 - 5))::bigint AS spread FROM orders")
def a07_global_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).agg(F.max("o_orderdate").alias("last"), F.min("o_orderdate").alias("first"), F.count("*").alias("n"), F.sum(F.abs(F.col("o_orderkey") % 11 - 5)).alias("spread"))


_W = "(PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)"


def _by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")


_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]


@query(f"SELECT l_orderkey, l_linenumber, l_quantity, (l_quantity - lag(l_quantity, 2) OVER w) / nullif(lag(l_quantity, 2) OVER w, 0) AS l_quantity_relchange_0_2 FROM lineitem WINDOW w AS {_W}")
def w05_relative_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.generate_lags(_by_supplier(spark, sf_dir), ["l_suppkey"], _ORDER, ["l_quantity"], [], relative_change=[[0, 2]])
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_quantity_relchange_0_2")


@query("""WITH m AS (SELECT o_custkey AS id, date_trunc('month', o_orderdate)::date AS m, max(o_orderpriority) AS worst, max(o_orderstatus = 'F') AS done FROM orders GROUP BY 1, 2)
SELECT *, min(worst) OVER w AS worst_rmin_6m, max(worst) OVER w AS worst_rmax_6m, min(done) OVER w AS done_rmin_6m, max(done) OVER w AS done_rmax_6m FROM m WINDOW w AS (PARTITION BY id ORDER BY m ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def w08_rolling_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("id"), F.trunc("o_orderdate", "month").alias("m"))
    monthly = grouped.agg(F.max("o_orderpriority").alias("worst"), F.max(F.col("o_orderstatus") == "F").alias("done"))
    return windows.rolling(monthly, ["id"], "m", [], ["worst", "done"], [6])


@query(f"SELECT l_orderkey, l_linenumber, l_quantity, lag(l_orderkey, 3) OVER w AS three_back FROM lineitem WINDOW w AS {_W}")
def w12_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = [{"operation": "lag", "column": "l_orderkey", "args": [3], "alias": "three_back"}]
    return windows.window_operations(_by_supplier(spark, sf_dir), ["l_suppkey"], ops, _ORDER).select("l_orderkey", "l_linenumber", "l_quantity", "three_back")


@query("SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(4) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS quarter FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_quantity)")
def w13_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = windows.window_operations(_by_supplier(spark, sf_dir), ["l_suppkey"], [{"operation": "rank", "alias": "rk"}, {"operation": "dense_rank", "alias": "dr"}], ["l_quantity"])
    return windows.window_operations(ranked, ["l_suppkey"], [{"operation": "ntile", "args": [4], "alias": "quarter"}], _ORDER).select("l_orderkey", "l_linenumber", "l_quantity", "rk", "dr", "quarter")


@query("SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders GROUP BY ALL")
def u02_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicates(orders(spark, sf_dir).select("o_custkey", "o_orderstatus", "o_orderpriority"), "all")


@query("SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders EXCEPT SELECT l_suppkey FROM lineitem")
def u03_intersect_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [table(spark, sf_dir, t).select(F.col(c).alias("k")) for t, c in (("customer", "c_custkey"), ("orders", "o_custkey"), ("lineitem", "l_suppkey"))]
    return ids[0].intersect(ids[1]).subtract(ids[2])


@query("WITH a AS (SELECT o_custkey AS k, count(*) AS s FROM orders GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS t FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) SELECT k, abs(s - t) / nullif(t, 0) AS rel FROM a LEFT JOIN b USING (k)")
def m04_relative_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = orders(spark, sf_dir).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("s"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("t"))
    return counts.select("k", exprs.relative_difference(F.col("s"), F.col("t")).alias("rel"))


@query("SELECT o_orderkey, o_orderdate::date + 40 AS plus, (o_orderdate::date + INTERVAL 25 MONTH)::date AS later FROM orders")
def d02_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dates.shifted(orders(spark, sf_dir), "plus", "o_orderdate", days=40)
    return dates.shifted(rows, "later", "o_orderdate", months=1, years=2).select("o_orderkey", "plus", "later")


@query("SELECT o_orderkey, o_orderdate::date - 40 AS before, (o_orderdate::date - INTERVAL 25 MONTH)::date AS sooner FROM orders")
def d03_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dates.subtracted(orders(spark, sf_dir), "before", "o_orderdate", days=40)
    return dates.subtracted(rows, "sooner", "o_orderdate", months=1, years=2).select("o_orderkey", "before", "sooner")


@query(f"SELECT o_orderkey, datediff('day', o_orderdate::date, DATE '2003-05-05') AS days, round({months_between_sql('DATE ' + chr(39) + '2003-05-05' + chr(39), 'o_orderdate::date')}, 6) AS months FROM orders")
def d04_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dates.difference(orders(spark, sf_dir), "days", "current_date", "o_orderdate", as_of="2003-05-05")
    rows = dates.difference(rows, "months", "current_date", "o_orderdate", "month", as_of="2003-05-05")
    return rows.select("o_orderkey", "days", F.round("months", 6).alias("months"))


@query("SELECT o_orderkey, date_trunc('month', o_orderdate)::date AS ym, strftime(o_orderdate, '%Y%m') AS monthyear_o_orderdate FROM orders")
def d07_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", F.year("o_orderdate").cast("string").alias("y"), F.month("o_orderdate").cast("string").alias("m"))
    return dates.month_codes(dates.year_month(rows, "ym", "y", "m"), ["o_orderdate"]).drop("o_orderdate", "y", "m")


@query("SELECT o_orderkey, ((year(o_orderdate) - 1990) * 12 + month(o_orderdate) - 3)::double AS months FROM (SELECT o_orderkey, date_trunc('month', o_orderdate) AS o_orderdate FROM orders)")
def d10_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", F.trunc("o_orderdate", "month").alias("release"), F.lit("1990-03-17").cast("date").alias("created"))
    return dates.tenure(rows, "months", "release", "created").select("o_orderkey", "months")


@query("SELECT o_orderkey, date_trunc('month', o_orderdate)::date AS month, CASE WHEN day(o_orderdate) > 15 THEN make_date(year(o_orderdate), month(o_orderdate), 16) ELSE date_trunc('month', o_orderdate)::date END AS half, make_date(year(o_orderdate), 12, 1) AS year FROM orders")
def d12_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.when(F.dayofmonth("o_orderdate") > 15, "-q2").otherwise("-q1"))
    rows = orders(spark, sf_dir).select("o_orderkey", "o_orderdate", code.alias("code"), F.year("o_orderdate").alias("y"))
    return rows.select("o_orderkey", exprs.month_start(F.col("o_orderdate")).alias("month"), exprs.half_month("code").alias("half"), exprs.year_only("y").alias("year"))


@query("SELECT 2 AS wrong, 'k' AS keys, 'd' AS stamps")
def r01_definition_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = 0
    for bad in ({"name": " "}, {"primary_keys": []}):
        try:
            FeatureTable(**{"name": "t", "description": "x", "primary_keys": ["k", "d"], "timestamp_keys": ["d"], **bad})
        except ValueError:
            wrong += 1
    good = FeatureTable("t", "x", ["k", "d"], ["d"])
    return spark.createDataFrame([(wrong, good.primary_keys[0], good.timestamp_keys[0])], "wrong int, keys string, stamps string")


@query("SELECT 'owner' AS name, 'b' AS value, true AS changed UNION ALL SELECT 'unit', 'x', false")
def r04_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(table(spark, sf_dir, "region"), properties={"owner": "a", "unit": "x"})
    changed = stored.set_properties({"owner": "b", "unit": "x"})
    return spark.createDataFrame([(k, v, k in changed) for k, v in stored.manifest()["properties"].items()], "name string, value string, changed boolean")


@query("SELECT r_regionkey, r_name FROM region UNION ALL SELECT n_nationkey + 100, n_name FROM nation")
def r06_full_write_and_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    stored.overwrite(table(spark, sf_dir, "region"))
    stored.append(table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).alias("r_regionkey"), F.col("n_name").alias("r_name")))
    return stored.read()


@query("SELECT 'raise' AS policy, 'refused' AS outcome, 3::bigint AS columns UNION ALL SELECT 'ignore', 'merge', 3 UNION ALL SELECT 'overwrite', 'overwrite', 2")
def r09_missing_column_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    nation = table(spark, sf_dir, "nation").withColumn("d", F.lit("2024-01-01").cast("date")).select("n_nationkey", "d", "n_name")
    for policy in ("raise", "ignore", "overwrite"):
        store = FeatureStore(spark, _root(spark))
        definition = FeatureTable("nation", "nations", ["n_nationkey", "d"], ["d"])
        store.save(definition, nation)
        try:
            outcome = store.save(definition, nation.drop("n_name"), on_missing=policy)["operation"]
        except ValueError:
            outcome = "refused"
        rows.append((policy, outcome, len(store.read("nation").columns)))
    return spark.createDataFrame(rows, "policy string, outcome string, columns bigint")


@query("SELECT 'nation' AS name, 'n_nationkey,d' AS keys, 'created' AS first, 'same' AS second")
def r10_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = FeatureStore(spark, _root(spark))
    definition = FeatureTable("nation", "nations", ["n_nationkey", "d"], ["d"])
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.lit("2024-01-01").cast("date").alias("d"))
    told = [store.save(definition, nation)["registered"] for _ in range(2)]
    entry = store.registry.get("nation")
    return spark.createDataFrame([("nation", ",".join(entry["primary_keys"]), "created" if told[0] else "same", "created" if told[1] else "same")], "name string, keys string, first string, second string")


@query("SELECT 'nation' AS name, 'a.t,b.t' AS added, '' AS removed")
def r13_registry_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, other = FeatureStore(spark, _root(spark)), FeatureStore(spark, _root(spark))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.lit("2024-01-01").cast("date").alias("d"))
    store.save(FeatureTable("nation", "nations", ["n_nationkey", "d"], ["d"], ["a.t", "b.t"]), nation)
    changed = store.registry.sync(other.registry)
    return spark.createDataFrame([(n, ",".join(c["added"]), ",".join(c["removed"])) for n, c in changed.items()], "name string, added string, removed string")


@query("SELECT 'CROSS_CHECKING' AS failed, 'FAILED' AS state UNION ALL SELECT 'OUTDATENESS', 'FAILED'")
def v03_ingestion_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    verdict = checks.validate(own, "orders", "ingestion", "o_orderdate", "2010-01-01", own.where("o_orderkey % 50 != 0"), ["o_orderkey"])
    return spark.createDataFrame([(name, verdict.state) for name in sorted(verdict.failed)], "failed string, state string")


@query("SELECT count(DISTINCT m)::bigint AS months, (datediff('month', min(m), max(m)) + 1 - count(DISTINCT m))::bigint AS gaps FROM (SELECT date_trunc('month', ts) AS m FROM events UNION ALL SELECT DATE '2024-05-01')")
def v11_monthly_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).union(spark.sql("SELECT DATE '2024-05-01'"))
    return checks.monthly_values(days, "d")


@query("SELECT 'fs_cus_transactions' AS feature, '2024-05-01' AS end_date, true AS forced")
def o01_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = jobs.checked_params({"env": "dev", "feature": "fs_cus_transactions", "end_date": "actual", "force_overwrite": "TRUE"}, date(2024, 5, 20))
    return spark.createDataFrame([(checked["feature"], checked["end_date"], checked["force_overwrite"])], "feature string, end_date string, forced boolean")


@query("SELECT unnest(['a', 'b', 'c', 'd']) AS task, unnest(['SUCCESS', 'FAILED', 'SKIPPED', 'SUCCESS']) AS state")
def o03_task_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fail() -> None:
        raise ValueError("as planned")

    tasks = [jobs.Task("a", lambda: 1), jobs.Task("b", fail, ["a"]), jobs.Task("c", lambda: 3, ["b"]), jobs.Task("d", lambda: 4, ["b", "c"], "all_done")]
    return spark.createDataFrame(list(jobs.run_graph(tasks).states.items()), "task string, state string")


@query(f"SELECT o_custkey::int AS pk_customer, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::date AS tpk_release_dt, sum(o_orderkey % 7 + 1)::int AS ctrx_trx_cnt_m FROM orders GROUP BY 1, 2")
def o02_feature_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = FeatureStore(spark, _root(spark))
    jobs.run_feature(spark, store, {"env": "dev", "feature": "fs_cus_transactions"}, sf_dir)
    return store.read("fs_cus_transactions").select(*features.KEYS.values(), "ctrx_trx_cnt_m")


@query("SELECT p_partkey, p_size, p_size::bigint * 2 AS twice FROM part WHERE p_size >= 10")
def o10_steps_from_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = [
        {"step": "filter_by_conditions", "params": {"conditions": ["p_size >= 10"]}},
        {"step": "select_columns", "params": {"columns": ["p_partkey", "p_size"]}},
        {"step": "binarize", "params": {"columns": {"twice": "cast(p_size as bigint) * 2"}}},
    ]
    return steps.run(table(spark, sf_dir, "part"), plan)


@query("SELECT unnest(['nothing', 'name', 'both']) AS config, unnest(['event_dt', 'day', 'day']) AS name, unnest(['yyyy-MM-dd', 'yyyy-MM-dd', 'yyyyMM']) AS format")
def v11_history_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    configs = {"nothing": {}, "name": {"date_col_filter": {"name": "day"}}, "both": {"date_col_filter": {"name": "day", "format": "yyyyMM"}}}
    return from_rows(spark, [(k, *checks.history_key(c)) for k, c in configs.items()], "config string, name string, format string")


_DATASETS = "(VALUES ('orders', 0), ('nation', 1), ('part', 2)) d(dataset, place)"


@query(f"SELECT asked, dataset, place FROM (VALUES ('all'), ('star'), ('omitted'), ('list')) a(asked), {_DATASETS} WHERE NOT (asked = 'omitted' AND dataset = 'nation')")
def o06_dataset_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = {"orders": {}, "nation": {}, "part": {}}
    asked = {"all": (None, None), "star": ("*", None), "omitted": ([], ["nation"]), "list": (["part", "orders", "nation"], None)}
    rows = [(name, dataset, list(config).index(dataset)) for name, (wanted, omit) in asked.items() for dataset in select_datasets(config, wanted, omit)]
    return from_rows(spark, rows, "asked string, dataset string, place int")


@query("SELECT unnest(['bare', 'missing', 'no database', 'good', 'closed']) AS source, unnest([false, false, false, true, false]) AS ok")
def r02_source_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, gone, root = f"default.tidemark_{uuid.uuid4().hex}", f"default.tidemark_{uuid.uuid4().hex}", _root(spark)
    save_table(table(spark, sf_dir, "nation"), name, f"{root}/nation")
    save_table(table(spark, sf_dir, "region"), gone, f"{root}/region")
    Files(spark).delete(f"{root}/region")  # listed in the catalog, but nothing to read
    rows = []
    for what, source in (("bare", "nation"), ("missing", "default.tidemark_nothing"), ("no database", "tidemark_nowhere.t"), ("good", name), ("closed", gone)):
        try:
            check_sources(spark, [source])
            rows.append((what, True))
        except ValueError:
            rows.append((what, False))
    return from_rows(spark, rows, "source string, ok boolean")


@query("SELECT 'monthly' AS name, 'orders of a month' AS description, 'k,d' AS primary_keys, 'd' AS timestamp_keys, 'a.t' AS sources, 'x' AS owner")
def r03_definition_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = FeatureTable("monthly", "orders of a month", ["k", "d"], ["d"], ["a.t"], {"owner": "x"}).config()
    row = ("monthly", config["description"], *(",".join(config[k]) for k in ("primary_keys", "timestamp_keys", "sources")), config["tags"]["owner"])
    return from_rows(spark, [row], "name string, description string, primary_keys string, timestamp_keys string, sources string, owner string")


@query("SELECT 'k' AS column, count(*) AS n FROM orders UNION ALL SELECT 'seen', count(*) FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'unseen', count(*) FROM orders WHERE o_orderdate >= DATE '1999-01-01'")
def r12_insert_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = SnapshotTable(spark, _root(spark))
    own = orders(spark, sf_dir).select("o_orderkey", F.year("o_orderdate").alias("y"))
    stored.overwrite(own.where("y < 1999").withColumn("new", F.lit(0)), ["y"])
    stored.insert_unseen(own.withColumn("new", F.lit(1)), "y")
    counts = stored.read().agg(F.count("*").alias("k"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("seen"), F.sum("new").alias("unseen"))
    return counts.unpivot([], ["k", "seen", "unseen"], "column", "n")


@query("""SELECT 'orders' AS "table", max(o_orderdate)::date AS last_date, datediff('month', max(o_orderdate), DATE '2010-01-01') AS months_behind FROM orders""")
def v02_require_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = checks.freshness(orders(spark, sf_dir), "orders", "o_orderdate", "2010-01-01")
    try:
        checks.require_fresh(results)
    except checks.StaleDataError as error:
        name, last, months = re.fullmatch(r"(\w+) ends at (\S+), (\d+) months behind", str(error)).groups()
        return from_rows(spark, [(name, date.fromisoformat(last), int(months))], "table string, last_date date, months_behind bigint")
    raise AssertionError("data from before 2010 count as fresh")


def _validated_by_layer(spark: SparkSession, sf_dir: str, layer: str) -> DataFrame:
    """Verdicts of a layer without a row of the layer before, after one that failed, and after one that passed."""
    ledger, own = Ledger(spark, _root(spark)), orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    rows = []
    for at, state in enumerate((None, "failed", "passed"), 1):
        if state:
            ledger.register(checks.Verdict({"MONTHLY_VAL": 3} if state == "failed" else {}), None, "orders", checks.BEFORE[layer], datetime(2024, 1, at, tzinfo=UTC))
        verdict = ledger.validate(own, "orders", layer, "o_orderdate", "1995-06-15" if at < 3 else "2010-01-15")
        ledger.register(verdict, None, "orders", layer, datetime(2024, 1, at, tzinfo=UTC))
        rows.append((at, verdict.state, ",".join(sorted(verdict.failed))))
    return from_rows(spark, rows, "run int, state string, failed string")


@query("SELECT unnest([1, 2, 3]) AS run, 'FAILED' AS state, unnest(['INGESTION_SAVED', 'INGESTION_SAVED', 'OUTDATENESS']) AS failed")
def v06_preprocessing_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated_by_layer(spark, sf_dir, "preprocessing")


@query("SELECT unnest([1, 2, 3]) AS run, 'FAILED' AS state, unnest(['PREPROCESSING_SAVED', 'PREPROCESSING_SAVED', 'OUTDATENESS']) AS failed")
def v07_feature_validator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated_by_layer(spark, sf_dir, "feature")


@query("SELECT unnest(['a', 'b', 'c']) AS task, unnest(['SUCCESS', 'INTERNAL_ERROR', 'SUCCESS']) AS state, unnest([true, false, false]) AS registered")
def o04_watched_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, other = FeatureStore(spark, _root(spark)), FeatureStore(spark, _root(spark))
    store.registry.register("a", {"sources": ["x.y"]})
    seen = iter([{"a": "RUNNING"}, {"a": "SUCCESS", "b": "INTERNAL_ERROR", "c": "PENDING"}, {"a": "SUCCESS", "c": "SUCCESS"}])
    outcome = jobs.watch(lambda: next(seen), ["a", "b", "c"], lambda name: store.registry.sync(other.registry, [name]), sleep=lambda _: None)
    return from_rows(spark, [(t, s, t in other.registry.names()) for t, s in outcome.states.items()], "task string, state string, registered boolean")


@query("""WITH a AS (SELECT *, user_id % 5 AS job, extract('day' FROM ts) AS run FROM events), n AS (SELECT job, max(run) AS run FROM a GROUP BY 1)
SELECT event_type AS task, arg_max(state, k) AS state FROM (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS state, {'s': ts, 't': CASE WHEN event_id % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END} AS k FROM a JOIN n USING (job, run) WHERE job = 2) GROUP BY 1""")
def o05_task_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = F.when(F.col("event_id") % 3 == 0, "FAILED").otherwise("SUCCESS").alias("state")
    attempts = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("job"), F.dayofmonth("ts").alias("run"), F.col("event_type").alias("task"), F.col("ts").alias("started"), state)
    job = jobs.find_job([{"name": "features", "tags": {"stage": "x"}}, {"name": "features", "tags": {"stage": "feature", "environment": "dev"}, "id": 2}], "features", {"stage": "feature"})
    return jobs.task_states(attempts, job["id"])
