"""Pipelines from data: a list of steps, each an operator's name and parameters, checked before anything runs."""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from tidemark.operators import aggregation, cleaning, dates, filters, joins, projection, windows

_OWN = {
    projection: "select_columns select_distinct rename_columns concat_columns constant_column decimals_to longs_to_integers standardize_output math_operations function_operations choose_columns_as_value categorize_by_fixed_values binarize cast_schema",
    filters: "filter_by_conditions filter_max exclude_sentinel filter_dates latest",
    cleaning: "standardize_na_values drop_na drop_duplicates impute trim_strings normalize_strings plain_strings lower_plain_strings standardize_column_names merge_duplicate_columns",
    dates: "shifted subtracted difference months_apart days_since year_month month_codes whole_months tenure expand_months with_calendar",
    aggregation: "aggregation_operations panel pivot_panel count_by_month",
    windows: "window_operations lag_index rolling changes generate_lags relative_strength",
    joins: "make_join exclude_ids point_in_time_join reconcile union_frames ratios percentages",
}
STEPS: dict[str, Callable[..., DataFrame]] = {name: getattr(module, name) for module, names in _OWN.items() for name in names.split()}


def load(path: str) -> list[dict[str, Any]]:
    """Steps from a JSON file."""
    return json.loads(Path(path).read_text())


def check(steps: Sequence[Mapping[str, Any]], frames: Sequence[str] = ()) -> None:
    """ValueError for unknown steps, parameters they don't take, parameters they lack, and unknown frames."""
    wrong, known = [], {*frames}
    for k, step in enumerate(steps):
        name, params = step.get("step"), dict(step.get("params") or {})
        if name not in STEPS:
            wrong.append(f"step {k}: no operator {name!r}")
            continue
        for frame in [step.get("on"), *(step.get("frames") or {}).values()]:
            if frame is not None and frame not in known:
                wrong.append(f"step {k} ({name}): no frame {frame!r}")
        params.update(dict.fromkeys(step.get("frames") or {}))
        try:
            inspect.signature(STEPS[name]).bind(None, **params)
        except TypeError as error:
            wrong.append(f"step {k} ({name}): {error}")
        if step.get("as"):
            known.add(step["as"])
    if wrong:
        raise ValueError("; ".join(wrong))


def run(df: DataFrame, steps: Sequence[Mapping[str, Any]], **frames: DataFrame) -> DataFrame:
    """The steps one after the other, lazily.

    A step: step (operator), params, and optionally on (a named frame to start from instead of the last result),
    frames ({parameter: frame name}) and as (a name under which the result is kept).
    """
    check(steps, list(frames))
    named = dict(frames)
    for step in steps:
        source = named[step["on"]] if step.get("on") else df
        others = {param: named[frame] for param, frame in (step.get("frames") or {}).items()}
        df = STEPS[step["step"]](source, **(step.get("params") or {}), **others)
        if step.get("as"):
            named[step["as"]] = df
    return df
