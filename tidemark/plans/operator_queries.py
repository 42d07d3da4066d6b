"""Queries that apply single operators to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.operators import aggregation, cleaning, dates, filters, joins, projection, windows
from tidemark.plans.feature_queries import rounded
from tidemark.plans.registry import query, table
from tidemark.sources.layers import sql_with_views
from tidemark.sources.star import money


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the date as a date."""
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


def _sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls and tokens that stand for missing values."""
    return orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 5 == 0, "N/A").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("price"),
    )


_SPARSE = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS price FROM orders"


# --- scans ---


@query("SELECT l_orderkey AS ok, l_linenumber AS ln, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned FROM lineitem WHERE l_quantity > 45")
def s01_scan_rename_case_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").where("l_quantity > 45")
    return items.select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"))


@query("""WITH m AS (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2002-01-01', INTERVAL 1 MONTH))::date AS release_dt)
SELECT release_dt, count(o_orderkey) AS n, count(DISTINCT o_custkey) AS customers FROM m LEFT JOIN orders ON date_trunc('month', o_orderdate) = release_dt GROUP BY 1""")
def s08_temp_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "SELECT release_dt, count(o_orderkey) AS n, count(DISTINCT o_custkey) AS customers FROM release_dates LEFT JOIN dated_orders ON trunc(o_orderdate, 'MM') = release_dt GROUP BY 1"
    return sql_with_views(spark, text, release_dates=dates.month_calendar(spark, "1995-01-01", "2002-01-01"), dated_orders=orders(spark, sf_dir))


# --- projections ---


@query("SELECT o_custkey, o_orderkey FROM orders")
def p01_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.select_columns(orders(spark, sf_dir), ["o_custkey", "o_orderkey"])


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def p02_select_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.select_distinct(orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])


@query("SELECT r_regionkey AS id, r_name AS name FROM region")
def p03_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.rename_columns(table(spark, sf_dir, "region"), {"r_regionkey": "id", "r_name": "name"})


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus || priority END AS both, 'p_' || priority AS tagged FROM (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' ELSE o_orderpriority END AS priority FROM orders)")
def p04_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = projection.concat_columns(_sparse(spark, sf_dir), "both", ["status", "priority"])
    return projection.concat_columns(both, "tagged", ["priority"], "p_").select("o_orderkey", "both", "tagged")


@query("SELECT r_regionkey, 7::bigint AS seven FROM region")
def p05_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.constant_column(table(spark, sf_dir, "region").select("r_regionkey"), "seven", "7", "bigint")


@query("SELECT o_orderkey, o_totalprice::decimal(18,2)::float AS price FROM orders")
def p06_decimals_to_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.decimals_to(orders(spark, sf_dir).select("o_orderkey", money("o_totalprice").alias("price")))


@query("SELECT o_orderkey::int AS o_orderkey, CASE WHEN o_orderkey * 500000 <= 2147483647 THEN (o_orderkey * 500000)::int END AS big FROM orders")
def p07_longs_to_integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.longs_to_integers(orders(spark, sf_dir).select("o_orderkey", (F.col("o_orderkey") * 500000).alias("big")))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice * l_discount AS product, l_quantity / nullif(l_linenumber - 1, 0) AS quotient, greatest(l_quantity, l_tax) AS top FROM lineitem")
def p09_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("less", F.col("l_linenumber") - 1)
    ops = [
        {"new_column_name": "product", "source_operator": "operator", "operator": "mul", "values": ["l_extendedprice", "l_discount"]},
        {"new_column_name": "quotient", "source_operator": "operator", "operator": "truediv", "values": ["l_quantity", "less"]},
        {"new_column_name": "top", "source_operator": "spark_function", "operator": "greatest", "values": ["l_quantity", "l_tax"]},
    ]
    return projection.math_operations(items, ops).select("l_orderkey", "l_linenumber", "product", "quotient", "top")


@query("SELECT p_partkey, upper(p_name) AS loud, p_name LIKE '%a%' AS has_a, p_size::varchar AS size_text FROM part")
def p10_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = [
        {"new_column_name": "loud", "source_function": "functions", "function": "upper", "values": ["p_name"]},
        {"new_column_name": "has_a", "source_function": "column", "function": "contains", "values": ["p_name", "a"]},
        {"new_column_name": "size_text", "source_function": "column", "function": "cast", "values": ["p_size", "string"]},
    ]
    return projection.function_operations(table(spark, sf_dir, "part"), ops).select("p_partkey", "loud", "has_a", "size_text")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice WHEN o_orderstatus = 'O' THEN 0 END AS chosen FROM orders")
def p11_choose_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = [{"condition": "o_orderstatus = 'F'", "column": "o_totalprice"}, {"condition": "o_orderstatus = 'O'", "column": "0"}]
    return projection.choose_columns_as_value(orders(spark, sf_dir), "chosen", cases, "NULL", "double").select("o_orderkey", "chosen")


@query("SELECT p_partkey, CASE WHEN p_size > 30 THEN 'big' WHEN p_size BETWEEN 10 AND 30 THEN 'mid' ELSE p_brand END AS category FROM part")
def p12_categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = {"big": "> 30", "mid": "between 10 and 30"}
    return projection.categorize_by_fixed_values(table(spark, sf_dir, "part"), "p_size", "category", values, "p_brand").select("p_partkey", "category")


@query("SELECT l_orderkey, l_linenumber, l_quantity > 25 AS many, NOT (l_quantity > 25) AND l_tax > 0.04 AS odd FROM lineitem")
def p13_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.binarize(table(spark, sf_dir, "lineitem"), {"many": "l_quantity > 25", "odd": "not many and l_tax > 0.04"}).select("l_orderkey", "l_linenumber", "many", "odd")


@query("SELECT o_orderkey::int AS id, strptime(strftime(o_orderdate, '%Y-%m') || CASE WHEN day(o_orderdate) > 15 THEN '-16' ELSE '-01' END, '%Y-%m-%d')::date AS half, try_cast(substr(o_orderpriority, 1, 1) AS int) AS digit FROM orders")
def p16_cast_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.when(F.dayofmonth("o_orderdate") > 15, "-q2").otherwise("-Q1"))
    rows = orders(spark, sf_dir).select("o_orderkey", half.alias("code"), F.substring("o_orderpriority", 1, 1).alias("first"))
    fields = {"o_orderkey": {"name": "id", "data_type": "int"}, "code": {"name": "half", "data_type": "DATE", "format_source": "yyyy-mm-qq"}, "first": {"name": "digit", "data_type": "int"}}
    return projection.cast_schema(rows, fields)


# --- filters ---


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IN ('F', 'P')")
def f11_filter_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_by_conditions(orders(spark, sf_dir), ["o_totalprice > 100000", "o_orderstatus in ('F', 'P')"]).select("o_orderkey")


@query("SELECT o_orderkey, o_orderdate::date AS o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def f12_filter_max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_max(orders(spark, sf_dir).select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)")
def f13_filter_max_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_max(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity").drop("l_quantity")


@query("SELECT 'nation' AS frame, count(*) AS n FROM nation WHERE n_regionkey = 1 UNION ALL SELECT 'region', count(*) FROM region")
def f14_filter_named_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.filter_named_frames({"nation": {"conditions": ["n_regionkey = 1"]}}, nation=table(spark, sf_dir, "nation"), region=table(spark, sf_dir, "region"))
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("frame"), "n") for name, df in kept.items()]
    return counts[0].union(counts[1])


@query("SELECT o_orderkey, o_orderdate::date AS o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1")
def t01_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.latest(orders(spark, sf_dir), "o_orderdate", ["o_orderstatus = 'F'"], ["o_orderkey"]).select("o_orderkey", "o_orderdate")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def t02_top_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = orders(spark, sf_dir).select("o_custkey", "o_orderkey", "o_totalprice")
    return cleaning.drop_duplicates(kept, "o_custkey", [F.desc("o_totalprice"), "o_orderkey"])


# --- cleaning ---


@query(f"SELECT o_orderkey, status, nullif(priority, 'N/A') AS priority, price FROM ({_SPARSE})")
def c01_standardize_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.standardize_na_values(_sparse(spark, sf_dir), {"priority": ["N/A", "NA"], "status": []})


@query(f"SELECT * FROM ({_SPARSE}) WHERE status IS NOT NULL AND price IS NOT NULL")
def c02_drop_na(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_na(_sparse(spark, sf_dir), ["status", "price"])


@query(f"SELECT DISTINCT status, priority FROM ({_SPARSE})")
def c03_drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicates(_sparse(spark, sf_dir).select("status", "priority"), "all")


@query(f"SELECT o_orderkey, coalesce(status, 'none') AS status, priority, coalesce(price, 0) AS price FROM ({_SPARSE})")
def c04_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.impute(_sparse(spark, sf_dir), {"status": "none", "price": 0.0})


@query("SELECT r_regionkey, r_name FROM region")
def c06_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.trim_strings(table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit("  "), "r_name", F.lit(" ")).alias("r_name")))


def _normalized_sql(column: str) -> str:
    plain = f"replace(replace(translate(lower(trim({column}, ' ')), '{exprs.ACCENTED}', '{exprs.UNACCENTED}'), 'æ', 'ae'), 'œ', 'oe')"
    return f"regexp_replace(regexp_replace(regexp_replace(trim({plain}, ' '), '[\\[\\]()* :.;<?/,''_&-]', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g')"


@query(f"SELECT doc_id, {_normalized_sql('text')} AS text, {_normalized_sql('source')} AS source FROM documents")
def c07_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_strings(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


_PLAIN = "[ \\t\\n\\r\\x0b\\x0c\\x{00a0}\\x{00ad}\\x1a\\x{0090}()\\[\\]{},:.;¿?¡!´`''‘/\\\\<>=+°³$¥çžæ^§&#%•š·‰©ª-]"


@query(f"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '{_PLAIN}', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS text FROM documents")
def c08_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.plain_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(f"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(lower(text), '{_PLAIN}', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS text FROM documents")
def c09_lower_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.lower_plain_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("SELECT r_regionkey AS ano_de_pago, r_name AS ma_name FROM region")
def c12_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.standardize_column_names(table(spark, sf_dir, "region").toDF("Año de Pago", "M@-Name!"))


@query("SELECT o_orderkey, coalesce(status, priority) AS s FROM (" + _SPARSE + ")")
def c13_merge_duplicate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.merge_duplicate_columns(_sparse(spark, sf_dir).select("o_orderkey", F.col("status").alias("s"), F.col("priority").alias("s")))


# --- joins and sets ---


@query("SELECT c_custkey, c_name, c_nationkey, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
def j01_make_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return joins.make_join(customer, table(spark, sf_dir, "nation"), "inner", ["c_nationkey"], ["n_nationkey"])


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, own = table(spark, sf_dir, "lineitem"), orders(spark, sf_dir)
    joined = items.join(own, items["l_orderkey"] == own["o_orderkey"])
    return joined.select("o_custkey", F.to_date("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_quantity")


_ASOF = """WITH s AS (SELECT o_custkey AS c, l_shipdate::date AS day, l_orderkey, l_linenumber, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY c, day ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC) = 1)
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate::date AS o_orderdate, r.l_orderkey, r.l_linenumber, r.l_quantity FROM orders o ASOF LEFT JOIN r ON o.o_custkey = r.c AND o.o_orderdate::date >= r.day"""


@query(_ASOF)
def j02_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    values = ["l_orderkey", "l_linenumber", "l_quantity"]
    return joins.point_in_time_join(left, _shipments(spark, sf_dir), ["o_custkey"], "o_orderdate", values, right_time="day")


@query(_ASOF)
def j02_point_in_time_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    values = ["l_orderkey", "l_linenumber", "l_quantity"]
    return joins.point_in_time_join(left, _shipments(spark, sf_dir), ["o_custkey"], "o_orderdate", values, right_time="day", bucket="year")


@query(_ASOF)
def j02_point_in_time_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate")
    values = ["l_orderkey", "l_linenumber", "l_quantity"]
    return joins.point_in_time_join_by_range(left, _shipments(spark, sf_dir), ["o_custkey"], "o_orderdate", values, "day", ["o_orderkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def j03_exclude_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    excluded = orders(spark, sf_dir).where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.exclude_ids(table(spark, sf_dir, "customer").select("c_custkey"), excluded, ["c_custkey"])


@query("WITH d AS (SELECT DISTINCT o_orderdate::date AS day FROM orders) SELECT o_orderkey, o_orderdate::date AS event_dt FROM orders JOIN d ON day = o_orderdate::date")
def j04_date_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("id_date")
    days = orders(spark, sf_dir).select(number, F.col("o_orderdate").alias("day")).distinct()
    return dates.with_calendar(orders(spark, sf_dir).select("o_orderkey", number), days, "id_date", "id_date", "day").select("o_orderkey", "event_dt")


@query("SELECT o_orderkey, o_custkey, count(*) OVER w AS n, max(o_totalprice) OVER w AS top FROM orders WINDOW w AS (PARTITION BY o_custkey)")
def j06_aggregate_and_join_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = [{"operation": "count", "column": "o_orderkey", "alias": "n"}, {"operation": "max", "column": "o_totalprice", "alias": "top"}]
    return aggregation.aggregation_operations(orders(spark, sf_dir), ["o_custkey"], ops, join=True).select("o_orderkey", "o_custkey", "n", "top")


@query("""WITH a AS (SELECT date_trunc('month', o_orderdate)::date AS month, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT date_trunc('month', l_shipdate)::date AS month, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(a.month, b.month) AS month, a.n AS source_n, b.n AS target_n, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff, abs(a.n - b.n) / nullif(b.n, 0) AS rel_diff FROM a FULL JOIN b ON a.month = b.month""")
def j07_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    ours = aggregation.count_by_month(table(spark, sf_dir, "orders"), "o_orderdate")
    theirs = aggregation.count_by_month(table(spark, sf_dir, "lineitem"), "l_shipdate")
    return joins.reconcile(ours, theirs, "month", "n")


@query("SELECT n_nationkey AS k, n_name AS name, n_regionkey AS parent FROM nation UNION ALL SELECT r_regionkey, r_name, NULL FROM region")
def u01_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").toDF("k", "name", "parent")
    return joins.union_frames(nation, table(spark, sf_dir, "region").toDF("k", "name"))


# --- aggregates ---


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::decimal(18,2))::double AS qty, count(DISTINCT l_suppkey) AS suppliers, max(l_shipdate)::date AS last FROM lineitem GROUP BY 1, 2")
def a01_aggregation_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumns({"l_quantity": money("l_quantity"), "l_shipdate": F.to_date("l_shipdate")})
    ops = [
        {"operation": "count", "alias": "n"},
        {"operation": "sum", "column": "l_quantity", "alias": "qty"},
        {"operation": "count_distinct", "column": "l_suppkey", "alias": "suppliers"},
        {"operation": "max", "column": "l_shipdate", "alias": "last"},
    ]
    return aggregation.aggregation_operations(items, ["l_returnflag", "l_linestatus"], ops).withColumn("qty", F.col("qty").cast("double"))


@query("SELECT l_linenumber, count(*) FILTER (WHERE l_returnflag = 'A') AS \"A_n\", max(l_tax) FILTER (WHERE l_returnflag = 'A') AS \"A_top\", count(*) FILTER (WHERE l_returnflag = 'R') AS \"R_n\", max(l_tax) FILTER (WHERE l_returnflag = 'R') AS \"R_top\" FROM lineitem GROUP BY 1")
def a02_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = [{"operation": "count", "alias": "n"}, {"operation": "max", "column": "l_tax", "alias": "top"}]
    return aggregation.aggregation_operations(table(spark, sf_dir, "lineitem"), ["l_linenumber"], ops, "l_returnflag", ["A", "R"])


@query("SELECT date_trunc('month', l_shipdate)::date AS month, count(*) AS n FROM lineitem GROUP BY 1")
def a08_count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregation.count_by_month(table(spark, sf_dir, "lineitem"), "l_shipdate")


# --- windows ---


@query("SELECT o_orderkey, row_number() OVER w AS rn, (sum(o_shippriority) OVER w)::bigint AS running, lag(o_orderkey, 2) OVER w AS two_back FROM (SELECT *, o_orderkey % 10 AS o_shippriority FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def w01_window_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = [{"operation": "row_number", "alias": "rn"}, {"operation": "sum", "column": "p", "alias": "running"}, {"operation": "lag", "column": "o_orderkey", "args": [2], "alias": "two_back"}]
    rows = orders(spark, sf_dir).withColumn("p", F.col("o_orderkey") % 10)
    return windows.window_operations(rows, ["o_custkey"], ops, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "rn", "running", "two_back")


@query("SELECT o_orderkey, (count(*) OVER (PARTITION BY o_custkey) - row_number() OVER w)::int AS lags_num, 'lag_' || (count(*) OVER (PARTITION BY o_custkey) - row_number() OVER w) AS lags FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def w02_lag_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.lag_index(orders(spark, sf_dir), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "lags_num", "lags")


_W3 = "OVER (PARTITION BY user_id ORDER BY ts, event_id"


@query(f"""SELECT event_id, lag(value, 1) {_W3}) AS value_lag_1, lag(value, 7) {_W3}) AS value_lag_7, round(avg(value) {_W3} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS value_mean,
round(stddev_samp(value) {_W3} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 6) AS value_std, (value - lag(value, 7) {_W3})) / nullif(lag(value, 7) {_W3}), 0) AS value_relchange_0_7 FROM events""")
def w03_generate_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    out = windows.generate_lags(events, ["user_id"], ["ts", "event_id"], ["value"], [1, 7], {"mean": [[-6, 0]], "std": [[-3, -1]]}, [[0, 7]])
    return out.select("event_id", "value_lag_1", "value_lag_7", F.round("value_mean_-6_0", 6).alias("value_mean"), F.round("value_std_-3_-1", 6).alias("value_std"), "value_relchange_0_7")


# --- dates ---


@query("""SELECT o_orderkey, (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::date AS release, (o_orderdate::date + 10 + INTERVAL 13 MONTH)::date AS later, ((o_orderdate::date - 5) - INTERVAL 14 MONTH)::date AS sooner,
datediff('day', o_orderdate::date, DATE '2002-01-01') AS age, strftime(o_orderdate, '%Y%m') AS monthyear_d, date_trunc('month', o_orderdate)::date AS ym, make_date(year(o_orderdate), 12, 1) AS year_only FROM orders""")
def d01_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", F.col("o_orderdate").alias("d"), F.year("o_orderdate").cast("string").alias("y"), F.month("o_orderdate").alias("m"))
    rows = dates.shifted(rows, "release", "d", months=1, floor=True)
    rows = dates.shifted(rows, "later", "d", days=10, months=1, years=1)
    rows = dates.subtracted(rows, "sooner", "d", days=5, months=2, years=1)
    rows = dates.days_since(rows, "age", "d", as_of="2002-01-01")
    rows = dates.year_month(dates.month_codes(rows, ["d"]), "ym", "y", "m")
    return rows.withColumn("year_only", exprs.year_only("y")).drop("d", "y", "m")


@query(f"SELECT c_custkey, {rounded('c_acctbal / 3', 2)} AS third FROM customer")
def m05_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.round(F.col("c_acctbal") / 3, 2).alias("third"))
