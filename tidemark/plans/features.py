"""The five customer feature tables: pure functions from a source frame to a standard output.

Each groups its source by customer and month of release, rolls the result over the last 3 and 6 rows of a customer,
and puts out keys and prefixed features in a fixed order. Rows with a null or sentinel id go. Rows are added up before
they are shuffled, so a customer with a large share of all rows reaches the windows as one row a month. (Dealing the
rows by customer first would save an exchange, at the price of putting such a customer's rows into one task.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import normalized_text, shift_date
from tidemark.operators.aggregation import panel, pivot_panel
from tidemark.operators.cleaning import normalize_strings
from tidemark.operators.dates import expand_months, tenure, whole_months
from tidemark.operators.filters import exclude_sentinel
from tidemark.operators.joins import percentages, ratios
from tidemark.operators.projection import roll_up, standardize_output
from tidemark.operators.windows import rolling

ID, RELEASE = "id_customer", "release_dt"
KEYS = {ID: "pk_customer", RELEASE: "tpk_release_dt"}
WINDOWS = (3, 6)


def _rolled_names(columns: list[str], stats: tuple[str, str]) -> list[str]:
    return [f"{c}_{stat}_{w}m" for c in columns for w in WINDOWS for stat in stats]


@dataclass(frozen=True)
class FeatureSpec:
    """name, prefix of features, columns rolled as numbers and as categories, and the columns before and after these."""

    name: str
    prefix: str
    description: str
    first: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    last: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        rolled = _rolled_names(list(self.numeric), ("ravg", "rstd")) + _rolled_names(list(self.categorical), ("rmin", "rmax"))
        return [ID, RELEASE, *self.first, *rolled, *self.last]

    @property
    def output_columns(self) -> list[str]:
        return [KEYS.get(c, self.prefix + c) for c in self.columns]

    def roll(self, df: DataFrame) -> DataFrame:
        return rolling(df, [ID], RELEASE, self.numeric, self.categorical, WINDOWS)

    def output(self, df: DataFrame) -> DataFrame:
        return standardize_output(df, self.columns, KEYS, self.prefix)


DEMOGRAPHIC = FeatureSpec(
    "fs_cus_demographic",
    "cdmg_",
    "who the customer is, month by month",
    ("gender", "educational_lvl1", "educational_lvl2", "marital_status_lvl1", "marital_status_lvl2", "avg_income_month", "zone_residence", "city", "segment", "cust_code_creation_time_months"),
)
CREDIT_RISK = FeatureSpec(
    "fs_cus_credit_risk",
    "chr_",
    "bureau score, debt and inquiries",
    ("credits_cnt", "bureau_score_sum", "total_banking_debt_sum", "bureau_inquiries_12m_sum", "rating_num"),
    ("bureau_score_sum", "total_banking_debt_sum", "bureau_inquiries_12m_sum"),
    ("rating_num",),
    ("total_banking_debt_sum_to_bureau_score_sum_ratio",),
)
#: Products by their normalised names.
PRODUCTS = {"economy": "vehicle_loan", "large": "mortgage_loan", "medium": "credit_card", "promo": "productive_credit"}
_PRODUCT_SUMS = tuple(f"{name}_amount_sum_m" for name in PRODUCTS.values())
_PRODUCT_FLAGS = tuple(f"ind_{name}_product" for name in PRODUCTS.values())
_AMOUNTS = tuple(f"amount_{stat}_m" for stat in ("sum", "avg", "min", "max"))
HOLDING_PRODUCTS = FeatureSpec(
    "fs_cus_holding_products", "chp_", "which products the customer holds", (*_PRODUCT_SUMS, *_PRODUCT_FLAGS, "products_cnt_m", *_AMOUNTS), (*_PRODUCT_SUMS, *_AMOUNTS), (*_PRODUCT_FLAGS, "products_cnt_m")
)
PAYMENT_BEHAVIOR = FeatureSpec(
    "fs_cus_payment_behavior",
    "cpym_",
    "how the customer pays",
    ("credits_cnt", "amt_total_balance_sum", "amt_paid_sum", "amt_total_credit_sum", "amt_installment_sum", "credit_duration_in_months", "time_to_close_in_months", "ind_installment_paid", "ind_did_min_payment", "rating_num"),
    ("amt_total_balance_sum", "amt_paid_sum", "amt_installment_sum"),
    ("ind_installment_paid", "ind_did_min_payment", "rating_num"),
    ("amt_paid_sum_pct", "amt_total_balance_sum_pct", "time_to_close_in_months_pct"),
)
_TRANSACTION_SUMS = ("trx_cnt_m", "amt_trx_sum_m", "last_transaction_recall_sum_m", "amt_trx_sum_m_to_trx_cnt_m_ratio")
TRANSACTIONS = FeatureSpec("fs_cus_transactions", "ctrx_", "how much the customer moves", _TRANSACTION_SUMS, _TRANSACTION_SUMS)
SPECS = {spec.name: spec for spec in (DEMOGRAPHIC, CREDIT_RISK, HOLDING_PRODUCTS, PAYMENT_BEHAVIOR, TRANSACTIONS)}


def _released(df: DataFrame, fmt: str | None, not_null: tuple[str, ...] = ()) -> DataFrame:
    """Clean rows with the month in which they can be used: the one after the event's."""
    kept = exclude_sentinel(df, ID, not_null=not_null)
    return kept.withColumn(RELEASE, shift_date("event_dt", fmt, months=1, floor=True))


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def demographic(customers: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """A row for each customer and month from the opening of the account on, within the dates."""
    clean = exclude_sentinel(normalize_strings(customers), ID)
    grouped = roll_up(clean, "educational_level", "educational_lvl1", {"superior": ["universitario", "postgrado"]}, ["secundaria", "primaria"], "ninguna")
    grouped = roll_up(grouped, "marital_status", "marital_status_lvl1", {"soltero": ["divorciado", "soltero"]}, otherwise="casado", keep_null=True)
    grouped = grouped.withColumnsRenamed({"educational_level": "educational_lvl2", "marital_status": "marital_status_lvl2"})
    monthly = expand_months(grouped, "customer_code_creation_date", start_date, end_date, RELEASE)
    return DEMOGRAPHIC.output(tenure(monthly, "cust_code_creation_time_months", RELEASE, "customer_code_creation_date"))


def credit_risk(bureau: DataFrame) -> DataFrame:
    rows = _released(bureau, "yyyy-MM", ("bureau_score",))
    monthly = panel(rows, [ID, RELEASE], ["bureau_score", "total_banking_debt", "bureau_inquiries_12m"], ["rating_num"], "credits_cnt")
    rolled = CREDIT_RISK.roll(_as_double(monthly, "total_banking_debt_sum"))
    return CREDIT_RISK.output(ratios(rolled, [("total_banking_debt_sum", "bureau_score_sum")]))


def holding_products(products: DataFrame, normalize: bool = True) -> DataFrame:
    """normalize: whether names of products still have to be normalised; a source that joins them from a table of its own
    does so there, once for each product instead of once for each row."""
    rows = _released(products, None, ("amount",))
    rows = rows.withColumn("product", normalized_text("product")) if normalize else rows
    stats = {"products_cnt": ["max"], "amount": ["sum", "avg", "min", "max"]}
    monthly = pivot_panel(rows, [ID, RELEASE], stats, "product", {"amount": "amount_sum_m"}, PRODUCTS)
    monthly = monthly.withColumnRenamed("products_cnt_max_m", "products_cnt_m")
    monthly = _as_double(monthly, *_PRODUCT_SUMS, *_AMOUNTS).fillna(0)
    return HOLDING_PRODUCTS.output(HOLDING_PRODUCTS.roll(monthly))


def payment_behavior(payments: DataFrame) -> DataFrame:
    rows = whole_months(_released(payments, None), "credit_duration_in_months", "closing_date", "openning_date")
    rows = whole_months(rows, "time_to_close_in_months", "closing_date", "event_dt")
    amounts = ["amt_total_balance", "amt_paid", "amt_total_credit", "amt_installment"]
    spans = ["credit_duration_in_months", "time_to_close_in_months"]
    monthly = panel(rows, [ID, RELEASE], [*amounts, *spans], ["ind_installment_paid", "ind_did_min_payment", "rating_num"], "credits_cnt")
    monthly = _as_double(monthly.withColumnsRenamed({f"{c}_sum": c for c in spans}), *(f"{c}_sum" for c in amounts))
    pairs = [("amt_paid_sum", "amt_total_credit_sum"), ("amt_total_balance_sum", "amt_total_credit_sum"), ("time_to_close_in_months", "credit_duration_in_months")]
    return PAYMENT_BEHAVIOR.output(percentages(PAYMENT_BEHAVIOR.roll(monthly), pairs))


def transactions(rows: DataFrame) -> DataFrame:
    stats = {c: ["sum"] for c in ("trx_cnt", "amt_trx", "last_transaction_recall")}
    monthly = pivot_panel(_released(rows, "yyyy-MM"), [ID, RELEASE], stats).withColumnRenamed("trx_cnt_sum_m", "trx_cnt_m")
    monthly = ratios(_as_double(monthly, "amt_trx_sum_m").fillna(0), [("amt_trx_sum_m", "trx_cnt_m")])
    return TRANSACTIONS.output(TRANSACTIONS.roll(monthly))
