"""Operators on tiny frames: semantics, errors, laziness."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import exprs
from tidemark.operators import aggregation, cleaning, dates, filters, joins, projection, windows

D = dt.date


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 1.0, D(2024, 1, 31)), (1, "b", None, D(2024, 2, 29)), (2, None, 0.0, D(2024, 3, 15)), (None, "a", 4.0, None)], "id bigint, s string, v double, d date")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_select_and_rename(df):
    assert projection.select_columns(df, ["v", "id"]).columns == ["v", "id"]
    assert projection.select_columns(df, []) is df
    with pytest.raises(KeyError):
        projection.select_columns(df, ["nope"])
    assert projection.rename_columns(df, {"s": "t"}).columns == ["id", "t", "v", "d"]
    with pytest.raises(ValueError):
        projection.rename_columns(df, {"s": "v"})
    with pytest.raises(KeyError):
        projection.rename_columns(df, {"zz": "v2"})
    assert projection.select_distinct(df, ["s"]).count() == 3


def test_concat(df):
    assert projection.concat_columns(df, "x", []) is df
    with pytest.raises(ValueError):
        projection.concat_columns(df, "x", ["s"])
    got = projection.concat_columns(projection.concat_columns(df, "x", ["s", "s"]), "y", ["s"], "p").select("x", "y")
    assert rows(got) == [("aa", "pa"), ("aa", "pa"), ("bb", "pb"), (None, None)]


def test_checked_narrowing(spark):
    big = spark.createDataFrame([(1, 2**40), (2, 5)], "k bigint, v bigint")
    assert rows(projection.longs_to_integers(big)) == [(1, None), (2, 5)]
    assert projection.longs_to_integers(big, keep=["k"]).dtypes == [("k", "bigint"), ("v", "int")]


def test_math_is_safe(df):
    ops = [{"new_column_name": "q", "source_operator": "operator", "operator": "truediv", "values": ["v", "v"]}]
    assert rows(projection.math_operations(df, ops).select("q")) == [(1.0,), (1.0,), (None,), (None,)]
    for bad in ({"source_operator": "operator", "operator": "__import__"}, {"source_operator": "spark_function", "operator": "udf"}, {"source_operator": "x", "operator": "add"}):
        with pytest.raises(ValueError):
            projection.math_operations(df, [{"new_column_name": "q", "values": ["v", "v"], **bad}])


def test_case_builders(df):
    chosen = projection.choose_columns_as_value(df, "c", [{"condition": "id = 1", "column": "s"}], cast_type="string")
    assert rows(chosen.select("c")) == [("a",), ("b",), (None,), (None,)]
    category = projection.categorize_by_fixed_values(df, "v", "c", {"low": "< 2", "high": ">= 2"}, "N/A")
    assert rows(category.select("c")) == [("high",), ("low",), ("low",), (None,)]
    named = projection.categorize_by_fixed_values(df, "v", "c", {"low": "< 1"}, "s")
    assert rows(named.select("c")) == [("a",), ("a",), ("b",), ("low",)]


def test_binarize_sees_earlier_columns(df):
    assert rows(projection.binarize(df, {"one": "id = 1", "two": "not one"}).select("one", "two")) == [(False, True), (None, None), (True, False), (True, False)]


def test_cast_schema(spark):
    raw = spark.createDataFrame([("7", "2024-01-q2", "31/12/2023"), ("x", "2024-02-Q1", "bad")], "a string, q string, d string")
    fields = {"a": {"name": "n", "data_type": "int"}, "q": {"name": "half", "data_type": "date", "format_source": "yyyy-mm-qq"}, "d": {"name": "day", "data_type": "DATE", "format_source": "dd/MM/yyyy"}}
    assert rows(projection.cast_schema(raw, fields)) == [(7, D(2024, 1, 16), D(2023, 12, 31)), (None, D(2024, 2, 1), None)]
    with pytest.raises(ValueError):
        projection.cast_schema(raw, {"d": {"name": "day", "data_type": "date"}})
    with pytest.raises(ValueError):
        projection.cast_schema(raw, {"d": {"name": "day"}})


def test_filters(df):
    assert filters.filter_by_conditions(df, None) is df
    assert filters.filter_by_conditions(df, ["id = 1", "v is null"]).count() == 1
    assert rows(filters.filter_max(df, "d").select("id")) == [(2,)]
    assert filters.filter_max(df.where("d is null"), "d").count() == 0
    assert rows(filters.exclude_sentinel(df, "id", "2", ["v"]).select("id")) == [(1,)]
    assert filters.filter_dates(df, "d", "2024-02-01", "2024-02-29").count() == 1
    assert filters.filter_dates(df, "d") is df
    assert set(filters.filter_named_frames({"a": {"conditions": ["id = 2"]}}, a=df, b=df)) == {"a", "b"}


def test_missing_values(df):
    assert rows(cleaning.standardize_na_values(df, {"s": ["a"], "v": []}).select("s")) == [("b",), (None,), (None,), (None,)]
    assert cleaning.drop_na(df, "all").count() == 1
    assert cleaning.drop_na(df, "id").count() == 3  # one column, not the letters i and d
    assert cleaning.drop_na(df, None) is df
    with pytest.raises(KeyError):
        cleaning.drop_na(df, ["zz"])
    assert cleaning.drop_duplicates(df, "s").count() == 3
    assert rows(cleaning.drop_duplicates(df.where("id is not null"), ["id"], [F.desc("d")]).select("id", "s")) == [(1, "b"), (2, None)]
    assert rows(cleaning.impute(df, {"s": "z"}).select("s")) == [("a",), ("a",), ("b",), ("z",)]


def test_text(spark):
    raw = spark.createDataFrame([(" Crédito  Hipotecario (Nº-1). ",), ("Œuvre & Æon",), (None,)], "t string")
    assert rows(cleaning.normalize_strings(raw)) == [("credito_hipotecario_nº_1",), ("oeuvre_aeon",), (None,)]
    assert rows(cleaning.plain_strings(raw))[0] == ("Crédito_Hipotecario_Nº_1",)
    assert cleaning.standard_name("Año de Pago (%)") == "ano_de_pago"
    with pytest.raises(ValueError):
        cleaning.standardize_column_names(raw.select(F.col("t").alias("a b"), F.col("t").alias("a_b")))
    twice = raw.select(F.lit(None).cast("string").alias("x"), F.col("t").alias("x"))
    assert cleaning.merge_duplicate_columns(twice).columns == ["x"]


def test_joins(spark, df):
    right = spark.createDataFrame([(1, "r", 9), (3, "q", 8)], "k bigint, s string, w int")
    joined = joins.make_join(df, right, "left", ["id"], ["k"])
    assert joined.columns == ["id", "s", "v", "d", "w"]
    assert rows(joined.select("id", "s", "w")) == [(1, "a", 9), (1, "b", 9), (2, None, None), (None, "a", None)]
    with pytest.raises(ValueError):
        joins.make_join(df, right, "inner", ["id"], [])
    with pytest.raises(KeyError):
        joins.make_join(df, right, "inner", ["id"], ["zz"])
    assert joins.make_join(df, right, "inner", ["id"], ["k"], drop_na=True).count() == 1
    assert rows(joins.exclude_ids(df, right.withColumnRenamed("k", "id"), ["id"]).select("id")) == [(2,), (None,)]


@pytest.mark.parametrize("seed", range(5))
def test_point_in_time_forms_agree(spark, seed):
    rnd = random.Random(seed)
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(20))
    left = spark.createDataFrame([(k, rnd.choice([1, 2, 3, None]), day()) for k in range(40)], "row int, k int, t date")
    right = spark.createDataFrame([(rnd.choice([1, 2, None]), day(), rnd.randrange(99)) for _ in range(60)], "k int, u date, x int")
    one = joins.point_in_time_join(left, right, ["k"], "t", ["x"], right_time="u")
    two = joins.point_in_time_join_by_range(left, right, ["k"], "t", ["x"], "u", ["row"])
    assert rows(one) == rows(two) and one.columns == ["row", "k", "t", "x"]
    want = []
    for r in left.collect():
        before = [(q.u, q.x) for q in right.collect() if r.k is not None and q.k == r.k and q.u <= r.t]
        want.append((r.row, r.k, r.t, max(before)[1] if before else None))
    assert rows(one) == sorted(want, key=str)
    for bucket in ("day", "month"):
        assert rows(joins.point_in_time_join(left, right, ["k"], "t", ["x"], right_time="u", bucket=bucket)) == sorted(want, key=str)
    collapsed = joins.point_in_time_join(left, right, ["k"], "t", ["x"], right_time="u", collapse=True)
    assert collapsed.count() == left.select("k", "t").distinct().count()


def test_point_in_time_makes_one_shuffle(spark):
    left, right = spark.range(10).selectExpr("id k", "id t"), spark.range(10).selectExpr("id k", "id t", "id x")
    plan = joins.point_in_time_join(left, right, ["k"], "t", ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_dates(spark, df):
    got = dates.shifted(dates.shifted(df, "a", "d", months=1, floor=True), "b", "d", days=1, months=1)
    assert rows(got.where("id = 1").select("a", "b")) == [(D(2024, 2, 1), D(2024, 3, 1)), (D(2024, 3, 1), D(2024, 4, 1))]
    with pytest.raises(ValueError):
        dates.difference(df, "x", "d", "d", "week")
    assert rows(dates.days_since(df, "x", "d", "2024-04-01").select("x")) == [(17,), (32,), (61,), (None,)]
    assert dates.month_calendar(spark, "2023-11-05", "2024-01-31").count() == 3
    assert rows(dates.expand_months(df.where("id = 1"), "d", "2024-01-01", "2024-03-01").select("s", "release_dt")) == [("a", D(2024, 2, 1)), ("a", D(2024, 3, 1)), ("b", D(2024, 3, 1))]
    assert rows(dates.month_codes(df, ["d"]).where("id = 2").select("monthyear_d")) == [("202403",)]


def test_aggregates(spark, df):
    with pytest.raises(ValueError):
        aggregation.aggregation_operations(df, [], [])
    with pytest.raises(ValueError):
        aggregation.aggregation_operations(df, ["id"], [{"operation": "udf", "column": "v"}])
    with pytest.raises(ValueError):
        aggregation.pivot_panel(df, ["id"], {}, pivot_column="s")
    back = aggregation.aggregation_operations(df, ["id"], [{"operation": "sum", "column": "v", "alias": "v"}], join=True)
    assert rows(back.select("id", "v")) == [(1, 1.0), (1, 1.0), (2, 0.0)]
    panel = aggregation.pivot_panel(df, ["id"], {"v": ["sum"]}, "s", {"v": "v_sum"}, {"a": "alpha"}, fill=0)
    assert rows(panel.where("id = 2")) == [(2, 0.0, False, 0.0)]


def test_windows(spark):
    series = spark.createDataFrame([(1, D(2024, m, 1), float(v)) for m, v in ((1, 10), (2, 12), (6, 9), (7, 0))], "id int, m date, v double")
    got = windows.rolling(series, ["id"], "m", ["v"], ["v"], [3])
    assert rows(got.where("month(m) = 7").select("v_ravg_3m", "v_rmin_3m", "v_rmax_3m")) == [(7.0, 0.0, 12.0)]
    by_month = windows.rolling(series, ["id"], "m", ["v"], [], [3], calendar=True)
    assert rows(by_month.where("month(m) = 7").select("v_ravg_3m")) == [(4.5,)]
    moved = windows.changes(series, ["id"], ["m"], ["v"], [1])
    assert rows(moved.where("month(m) = 2").select("v_lag_1m", "v_diff_1m", "v_roc_1m")) == [(10.0, 2.0, 0.2)]
    assert rows(windows.lag_index(series, ["id"], ["m"]).select("lags_num", "lags")) == [(0, "lag_0"), (1, "lag_1"), (2, "lag_2"), (3, "lag_3")]
    with pytest.raises(ValueError):
        windows.generate_lags(series, ["id"], [], ["v"], [1])
    lagged = windows.generate_lags(series, ["id"], ["m"], ["v"], [1], {"mean": [[-1, 0]]}, [[0, 1]])
    assert rows(lagged.where("month(m) = 2").select("v_lag_1", "v_mean_-1_0", "v_relchange_0_1")) == [(10.0, 11.0, 0.2)]
    rsi = windows.relative_strength(series, ["id"], ["m"], "v", 3)
    assert rows(rsi.select("v_rsi_3")) == sorted([(None,), (None,), (40.0,), (round(100 - 100 / (1 + (2 / 3) / 4), 4),)], key=str)


def test_one_window_node(spark):
    series = spark.range(5).selectExpr("id", "id m", "cast(id as double) v")
    plan = windows.rolling(series, ["id"], "m", ["v"], ["v"], [3, 6])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1


def test_ratio_names(df):
    with pytest.raises(ValueError):
        joins.percentages(df, [("v", "id"), ("v", "v")])
    assert rows(joins.ratios(df, [("id", "v")]).select("id_to_v_ratio")) == [(1.0,), (None,), (None,), (None,)]
    assert exprs.is_null_token("'None'") and not exprs.is_null_token("x")
