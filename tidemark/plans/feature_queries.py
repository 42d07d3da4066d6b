"""Queries for the five feature tables and for what they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import ratio
from tidemark.operators import aggregation, dates, filters, joins, projection, windows
from tidemark.plans import features
from tidemark.plans.registry import query, table
from tidemark.sources import star

START, END = "1995-01-01", "2002-01-01"
_RELEASE = "(date_trunc('month', {day}) + INTERVAL 1 MONTH)::date"
_RATING = "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 4 WHEN '5' THEN 5 ELSE 0 END"


def rounded(sql: str, digits: int = 4) -> str:
    """SQL that rounds a double by its decimal text, half up, as Spark does."""
    return f"round(({sql})::varchar::decimal(38,14), {digits})::double"


def _rolled_sql(spec: features.FeatureSpec, monthly: str, extra: dict[str, str] | None = None) -> str:
    """SQL for a feature table over a monthly relation that has the spec's first columns."""
    frame = "OVER (PARTITION BY id_customer ORDER BY release_dt ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    outs = ["id_customer::int AS pk_customer", "release_dt AS tpk_release_dt", *(f"{c} AS {spec.prefix}{c}" for c in spec.first)]
    for c in spec.numeric:
        for w in features.WINDOWS:
            over = frame.format(n=w - 1)
            outs += [f"{rounded(f'avg({c}) {over}')} AS {spec.prefix}{c}_ravg_{w}m", f"{rounded(f'stddev_samp({c}) {over}')} AS {spec.prefix}{c}_rstd_{w}m"]
    for c in spec.categorical:
        for w in features.WINDOWS:
            over = frame.format(n=w - 1)
            outs += [f"min({c}) {over} AS {spec.prefix}{c}_rmin_{w}m", f"max({c}) {over} AS {spec.prefix}{c}_rmax_{w}m"]
    outs += [f"{sql} AS {spec.prefix}{c}" for c, sql in (extra or {}).items()]
    return f"WITH m AS ({monthly}) SELECT {', '.join(outs)} FROM m"


_MONTHS_BETWEEN = """CASE WHEN day({a}) = day({b}) OR (last_day({a}) = {a} AND last_day({b}) = {b}) THEN (year({a}) - year({b})) * 12 + month({a}) - month({b})
 ELSE (year({a}) - year({b})) * 12 + month({a}) - month({b}) + (day({a}) - day({b})) / 31.0 END"""


def months_between_sql(a: str, b: str) -> str:
    return _MONTHS_BETWEEN.format(a=a, b=b)


@query(f"""
WITH o AS (SELECT o_custkey, min(o_orderdate)::date AS opened FROM orders GROUP BY 1),
c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'primaria' WHEN 'BUILDING' THEN 'secundaria' WHEN 'FURNITURE' THEN 'universitario' WHEN 'HOUSEHOLD' THEN 'postgrado' END AS edu,
  CASE c_custkey % 3 WHEN 0 THEN 'soltero' WHEN 1 THEN 'divorciado' ELSE 'casado' END AS mar, c_acctbal, lower(replace(r_name, ' ', '_')) AS zone,
  lower(replace(n_name, ' ', '_')) AS city, lower(c_mktsegment) AS segment, opened
  FROM customer JOIN o ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
d AS (SELECT unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 MONTH))::date AS release_dt)
SELECT id::int AS pk_customer, release_dt AS tpk_release_dt, gender AS cdmg_gender,
  CASE WHEN edu IN ('universitario', 'postgrado') THEN 'superior' WHEN edu IN ('secundaria', 'primaria') THEN edu ELSE 'ninguna' END AS cdmg_educational_lvl1, edu AS cdmg_educational_lvl2,
  CASE WHEN mar IN ('divorciado', 'soltero') THEN 'soltero' ELSE 'casado' END AS cdmg_marital_status_lvl1, mar AS cdmg_marital_status_lvl2, c_acctbal AS cdmg_avg_income_month,
  zone AS cdmg_zone_residence, city AS cdmg_city, segment AS cdmg_segment,
  ((year(release_dt) - year(opened)) * 12 + month(release_dt) - month(opened))::double AS cdmg_cust_code_creation_time_months
FROM c, d WHERE release_dt >= opened""")
def f01_fs_cus_demographic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.demographic(star.customers(spark, sf_dir), START, END)


@query(
    _rolled_sql(
        features.CREDIT_RISK,
        f"""SELECT o_custkey AS id_customer, {_RELEASE.format(day="o_orderdate")} AS release_dt, count(*)::int AS credits_cnt, sum(floor(o_totalprice / 1000))::int AS bureau_score_sum,
 sum(o_totalprice::decimal(18,2))::double AS total_banking_debt_sum, sum(o_orderkey % 5)::int AS bureau_inquiries_12m_sum, max({_RATING}) AS rating_num FROM orders GROUP BY 1, 2""",
        {"total_banking_debt_sum_to_bureau_score_sum_ratio": rounded("total_banking_debt_sum / nullif(bureau_score_sum, 0)")},
    )
)
def f02_fs_cus_credit_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.credit_risk(star.bureau(spark, sf_dir))


def _holding_monthly() -> str:
    sums = ", ".join(f"sum(CASE WHEN p = '{value}' THEN amount ELSE 0 END)::double AS {name}_amount_sum_m, sum(CASE WHEN p = '{value}' THEN 1 ELSE 0 END) > 0 AS ind_{name}_product" for value, name in features.PRODUCTS.items())
    return f"""SELECT o_custkey AS id_customer, {_RELEASE.format(day="o_orderdate")} AS release_dt, {sums}, max(l_linenumber) AS products_cnt_m,
 sum(amount)::double AS amount_sum_m, round(sum(amount)::double / count(amount), 6) AS amount_avg_m, min(amount)::double AS amount_min_m, max(amount)::double AS amount_max_m
 FROM (SELECT o_custkey, o_orderdate, l_linenumber, lower(p_type) AS p, l_extendedprice::decimal(18,2) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey) GROUP BY 1, 2"""


@query(_rolled_sql(features.HOLDING_PRODUCTS, _holding_monthly()))
def f03_fs_cus_holding_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.holding_products(star.products(spark, sf_dir), normalize=False)


_PAID = "(l_extendedprice::decimal(18,2) * (1 - l_discount::decimal(4,2)))::decimal(18,2)"


@query(
    _rolled_sql(
        features.PAYMENT_BEHAVIOR,
        f"""SELECT id_customer, {_RELEASE.format(day="event_dt")} AS release_dt, count(*)::int AS credits_cnt, sum(total)::double AS amt_total_balance_sum, sum(paid)::double AS amt_paid_sum,
 sum(total)::double AS amt_total_credit_sum, sum(installment)::double AS amt_installment_sum, sum(trunc({months_between_sql("closing", "opening")}))::int AS credit_duration_in_months,
 sum(trunc({months_between_sql("closing", "event_dt")}))::int AS time_to_close_in_months, max(f) AS ind_installment_paid, max(p) AS ind_did_min_payment, max(rating) AS rating_num
 FROM (SELECT o_custkey AS id_customer, date_trunc('month', o_orderdate)::date AS event_dt, o_orderdate::date AS opening, (shipped + INTERVAL 24 MONTH)::date AS closing, o_totalprice::decimal(18,2) AS total,
 paid, installment, o_orderstatus = 'F' AS f, o_orderstatus <> 'O' AS p, {_RATING} AS rating FROM orders JOIN
 (SELECT l_orderkey, sum({_PAID}) AS paid, max(l_shipdate)::date AS shipped, max(l_extendedprice::decimal(18,2)) AS installment FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey) GROUP BY 1, 2""",
        {
            "amt_paid_sum_pct": rounded("amt_paid_sum / nullif(amt_total_credit_sum, 0) * 100"),
            "amt_total_balance_sum_pct": rounded("amt_total_balance_sum / nullif(amt_total_credit_sum, 0) * 100"),
            "time_to_close_in_months_pct": rounded("time_to_close_in_months / nullif(credit_duration_in_months, 0) * 100"),
        },
    )
)
def f04_fs_cus_payment_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.payment_behavior(star.payments(spark, sf_dir))


_TRANSACTIONS_MONTHLY = f"""SELECT *, {rounded("amt_trx_sum_m / nullif(trx_cnt_m, 0)")} AS amt_trx_sum_m_to_trx_cnt_m_ratio FROM (
 SELECT o_custkey AS id_customer, {_RELEASE.format(day="o_orderdate")} AS release_dt, sum(o_orderkey % 7 + 1)::int AS trx_cnt_m, sum(o_totalprice::decimal(18,2))::double AS amt_trx_sum_m,
 sum(day(o_orderdate))::int AS last_transaction_recall_sum_m FROM orders GROUP BY 1, 2)"""


@query(_rolled_sql(features.TRANSACTIONS, _TRANSACTIONS_MONTHLY))
def f05_fs_cus_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.transactions(star.transactions(spark, sf_dir))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey::varchar <> '7' AND o_totalprice IS NOT NULL")
def f06_sentinel_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.exclude_sentinel(table(spark, sf_dir, "orders"), "o_custkey", "7", ["o_totalprice"]).select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_orderdate::date AS d FROM orders WHERE o_orderdate::date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def f07_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return filters.filter_dates(orders, "d", "1996-01-01", "1996-12-31")


@query(f"SELECT o_orderkey, {_RATING} AS rating_num FROM orders")
def f08_rating_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", star.rating().alias("rating_num"))


@query("SELECT o_custkey, date_trunc('month', o_orderdate)::date AS m, count(*) AS credits_cnt, sum(o_totalprice::decimal(18,2))::double AS o_totalprice_sum, max(o_orderstatus) AS o_orderstatus FROM orders GROUP BY 1, 2")
def f09_panel_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("m"), star.money("o_totalprice").alias("o_totalprice"), "o_orderstatus")
    return aggregation.panel(orders, ["o_custkey", "m"], ["o_totalprice"], ["o_orderstatus"], "credits_cnt").withColumn("o_totalprice_sum", F.col("o_totalprice_sum").cast("double"))


@query("""SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END)::double AS accepted_qty_sum, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) > 0 AS ind_accepted_l_returnflag,
sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END)::double AS returned_qty_sum, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > 0 AS ind_returned_l_returnflag,
max(l_linenumber) AS l_linenumber_max_m, min(l_quantity) AS l_quantity_min_m FROM lineitem GROUP BY 1""")
def f10_pivot_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = {"l_linenumber": ["max"], "l_quantity": ["min"]}
    return aggregation.pivot_panel(table(spark, sf_dir, "lineitem"), ["l_suppkey"], stats, "l_returnflag", {"l_quantity": "qty_sum"}, {"A": "accepted", "R": "returned"})


def _orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id"), F.trunc("o_orderdate", "month").alias("m"))
    return orders.agg(F.sum(star.money("o_totalprice")).cast("double").alias("amt"), F.count("*").alias("cnt"))


_BY_MONTH = "SELECT o_custkey AS id, date_trunc('month', o_orderdate)::date AS m, sum(o_totalprice::decimal(18,2))::double AS amt, count(*) AS cnt FROM orders GROUP BY 1, 2"
_LAST3 = "OVER (PARTITION BY id ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"


@query(f"SELECT *, {rounded(f'avg(amt) {_LAST3}')} AS amt_ravg_3m, {rounded(f'stddev_samp(amt) {_LAST3}')} AS amt_rstd_3m, min(cnt) {_LAST3} AS cnt_rmin_3m, max(cnt) {_LAST3} AS cnt_rmax_3m FROM ({_BY_MONTH})")
def w06_rolling_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.rolling(_orders_by_month(spark, sf_dir), ["id"], "m", ["amt"], ["cnt"], [3])


_MONTHS6 = "OVER (PARTITION BY id ORDER BY year(m) * 12 + month(m) RANGE BETWEEN 5 PRECEDING AND CURRENT ROW)"


@query(f"SELECT *, {rounded(f'avg(amt) {_MONTHS6}')} AS amt_ravg_6m, {rounded(f'stddev_samp(amt) {_MONTHS6}')} AS amt_rstd_6m FROM ({_BY_MONTH})")
def w07_rolling_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.rolling(_orders_by_month(spark, sf_dir), ["id"], "m", ["amt"], [], [6], calendar=True)


_LAG = "lag(amt, {n}) OVER (PARTITION BY id ORDER BY m)"


@query(
    "SELECT *, "
    + ", ".join(f"{_LAG.format(n=n)} AS amt_lag_{n}m, amt - {_LAG.format(n=n)} AS amt_diff_{n}m, {rounded(f'(amt - {_LAG.format(n=n)}) / nullif({_LAG.format(n=n)}, 0)')} AS amt_roc_{n}m" for n in (1, 3, 6))
    + f" FROM ({_BY_MONTH})"
)
def w10_lag_diff_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.changes(_orders_by_month(spark, sf_dir), ["id"], ["m"], ["amt"])


@query(f"""WITH d AS (SELECT event_id, user_id, ts, value, value - lag(value) OVER w AS delta FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT event_id, avg(greatest(delta, 0)) FILTER (WHERE delta IS NOT NULL) OVER f AS gain, avg(greatest(-delta, 0)) FILTER (WHERE delta IS NOT NULL) OVER f AS loss FROM d WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT event_id, CASE WHEN loss <> 0 THEN {rounded('100 - 100 / (1 + gain / loss)')} END AS value_rsi_14 FROM g""")
def w11_relative_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return windows.relative_strength(events, ["user_id"], ["ts", "event_id"], "value").select("event_id", "value_rsi_14")


@query(f"SELECT o_orderkey, {rounded('o_totalprice / nullif(o_orderkey % 3, 0)')} AS o_totalprice_to_r_ratio, {rounded('o_totalprice / nullif(o_orderkey % 3, 0) * 100')} AS o_totalprice_pct, coalesce(o_totalprice / nullif(o_orderkey % 3, 0), 0) AS plain FROM orders")
def m01_ratios_and_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") % 3).alias("r"))
    both = joins.percentages(joins.ratios(orders, [("o_totalprice", "r")]), [("o_totalprice", "r")])
    return both.withColumn("plain", ratio("o_totalprice", "r", digits=None, otherwise=0.0)).drop("o_totalprice", "r")


@query(f"SELECT l_orderkey, l_linenumber, trunc({months_between_sql('l_shipdate::date', 'o_orderdate::date')})::int AS whole, round({months_between_sql('l_shipdate::date', 'o_orderdate::date')}, 6) AS months FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def d09_months_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("s"), F.to_date("o_orderdate").alias("o"))
    out = dates.months_apart(dates.whole_months(joined, "whole", "s", "o"), "months", "s", "o")
    return out.select("l_orderkey", "l_linenumber", "whole", F.round("months", 6).alias("months"))


@query(f"SELECT unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 MONTH))::date AS release_dt")
def d11_month_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.month_calendar(spark, START, END)


_FIRST_MONTH = "CASE WHEN day(o_orderdate) = 1 THEN o_orderdate::date ELSE (date_trunc('month', o_orderdate) + INTERVAL 1 MONTH)::date END"


@query(f"SELECT o_orderkey, unnest(generate_series(greatest(DATE '{START}', {_FIRST_MONTH}), DATE '{END}', INTERVAL 1 MONTH))::date AS release_dt FROM orders")
def j05_calendar_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return dates.expand_months(orders, "d", START, END).select("o_orderkey", "release_dt")


@query("SELECT o_custkey::int AS pk, o_orderdate::date AS dt, o_totalprice::float AS x_price, o_orderkey::int AS x_key FROM orders")
def p08_output_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.to_date("o_orderdate").alias("d"), star.money("o_totalprice").alias("price"), F.col("o_orderkey").alias("key"))
    return projection.standardize_output(orders, ["id", "d", "price", "key"], {"id": "pk", "d": "dt"}, "x_")
