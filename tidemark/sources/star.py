"""The five logical sources of the feature tables, built from the star-schema test tables.

Amounts are exact decimals until they are summed, so sums don't depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import normalized_text

RATINGS = {"1": 1, "2": 2, "3": 3, "4": 4, "5": 5}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, income, segment, city, zone, education, marital status, gender and opening date (the first order's)."""
    opened = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("opened"))
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    place = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    education = F.element_at(F.create_map(*(F.lit(x) for pair in (("AUTOMOBILE", "Primaria"), ("BUILDING", "Secundaria"), ("FURNITURE", "Universitario"), ("HOUSEHOLD", "Postgrado")) for x in pair)), F.col("c_mktsegment"))
    marital = F.when(F.col("c_custkey") % 3 == 0, "Soltero").when(F.col("c_custkey") % 3 == 1, "Divorciado").otherwise("Casado")
    joined = _table(spark, sf_dir, "customer").join(opened, F.col("c_custkey") == F.col("o_custkey")).join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("c_custkey").alias("id_customer"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        marital.alias("marital_status"),
        education.alias("educational_level"),
        F.col("c_acctbal").alias("avg_income_month"),
        F.col("r_name").alias("zone_residence"),
        F.col("n_name").alias("city"),
        F.col("opened").alias("customer_code_creation_date"),
        F.col("c_mktsegment").alias("segment"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, event date, product (normalised), amount and products held, a row for each line item."""
    orders, items, part = (_table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    part = part.select("p_partkey", normalized_text("p_type").alias("p_type"))
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).join(part, items["l_partkey"] == part["p_partkey"])
    return joined.select(
        F.col("o_custkey").alias("id_customer"),
        F.to_date("o_orderdate").alias("event_dt"),
        F.col("p_type").alias("product"),
        money("l_extendedprice").alias("amount"),
        F.col("l_linenumber").alias("products_cnt"),
    )


def rating():
    """The first digit of the priority, 0 for others."""
    return F.coalesce(F.when(F.substring("o_orderpriority", 1, 1).isin(*RATINGS), F.substring("o_orderpriority", 1, 1).cast("int")), F.lit(0))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, event date, opening and closing date, amounts, paid flags and rating, a row for each order."""
    lines = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum((money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,2)")).alias("amt_paid"),
            F.max(F.to_date("l_shipdate")).alias("shipped"),
            F.max(money("l_extendedprice")).alias("amt_installment"),
        )
    )
    orders = _table(spark, sf_dir, "orders")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select(
        F.col("o_custkey").alias("id_customer"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("event_dt"),
        F.to_date("o_orderdate").alias("openning_date"),
        F.add_months("shipped", 24).alias("closing_date"),
        money("o_totalprice").alias("amt_total_balance"),
        "amt_paid",
        money("o_totalprice").alias("amt_total_credit"),
        "amt_installment",
        (F.col("o_orderstatus") == "F").alias("ind_installment_paid"),
        (F.col("o_orderstatus") != "O").alias("ind_did_min_payment"),
        rating().alias("rating_num"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, period (yyyy-MM), score, rating, inquiries and debt, a row for each order."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_customer"),
        F.date_format("o_orderdate", "yyyy-MM").alias("event_dt"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("bureau_score"),
        rating().alias("rating_num"),
        (F.col("o_orderkey") % 5).cast("int").alias("bureau_inquiries_12m"),
        money("o_totalprice").alias("total_banking_debt"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, period (yyyy-MM), transactions, amount and recency, a row for each order."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id_customer"),
        F.date_format("o_orderdate", "yyyy-MM").alias("event_dt"),
        (F.col("o_orderkey") % 7 + 1).alias("trx_cnt"),
        money("o_totalprice").alias("amt_trx"),
        F.dayofmonth("o_orderdate").alias("last_transaction_recall"),
    )
