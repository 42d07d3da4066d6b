"""Running feature pipelines: checked parameters, a small task graph, events for registration."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import partial
from graphlib import TopologicalSorter
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import features
from tidemark.sources import star
from tidemark.store.evolution import Policy
from tidemark.store.feature_store import FeatureStore, FeatureTable

log = logging.getLogger("tidemark.jobs")

_FLAGS = ("force_overwrite", "omit_data_validation_errors")


def month_or_actual(value: str, as_of: date | None = None) -> str:
    """A date as given; 'actual' is the first of the month of as_of (today without it)."""
    return (as_of or date.today()).replace(day=1).isoformat() if value == "actual" else date.fromisoformat(value).isoformat()


def checked_params(params: Mapping[str, Any], as_of: date | None = None) -> dict[str, Any]:
    """Run parameters with types: env, feature, dates and flags given as true or false."""
    wrong = [f"{name} is needed" for name in ("env", "feature") if not params.get(name)]
    if params.get("feature") and params["feature"] not in features.SPECS:
        wrong.append(f"there is no feature table {params['feature']!r}")
    out = dict(params)
    for flag in _FLAGS:
        text = str(params.get(flag, "false")).lower()
        if text not in ("true", "false"):
            wrong.append(f"{flag} is neither true nor false")
        out[flag] = text == "true"
    for name in ("start_date", "end_date"):
        if params.get(name):
            try:
                out[name] = month_or_actual(params[name], as_of)
            except ValueError:
                wrong.append(f"{name} isn't a date")
    if wrong:
        raise ValueError("; ".join(wrong))
    return out


#: Feature tables: the adapter of their source and the function that builds them.
BUILDERS: dict[str, tuple[Callable[[SparkSession, str], DataFrame], Callable[..., DataFrame]]] = {
    "fs_cus_demographic": (star.customers, features.demographic),
    "fs_cus_credit_risk": (star.bureau, features.credit_risk),
    "fs_cus_holding_products": (star.products, partial(features.holding_products, normalize=False)),
    "fs_cus_payment_behavior": (star.payments, features.payment_behavior),
    "fs_cus_transactions": (star.transactions, features.transactions),
}


def definition(name: str) -> FeatureTable:
    spec = features.SPECS[name]
    return FeatureTable(name, spec.description, list(features.KEYS.values()), [features.KEYS[features.RELEASE]], tags={"prefix": spec.prefix})


def run_feature(spark: SparkSession, store: FeatureStore, params: Mapping[str, Any], sf_dir: str) -> dict[str, Any]:
    """Build one feature table and save it."""
    checked = checked_params(params)
    name = checked["feature"]
    source, build = BUILDERS[name]
    dates = (checked.get("start_date", "2019-01-01"), checked.get("end_date", month_or_actual("actual"))) if name == features.DEMOGRAPHIC.name else ()
    on_missing: Policy = "ignore" if checked["omit_data_validation_errors"] else "raise"
    try:
        return store.save(definition(name), build(source(spark, sf_dir), *dates), on_missing=on_missing, force_overwrite=checked["force_overwrite"])
    except Exception as error:
        raise RuntimeError(f"feature table {name} wasn't saved in {checked['env']}") from error


@dataclass
class Task:
    """run_if: 'all_success' skips a task unless all before it succeeded, 'all_done' runs it whatever became of them."""

    name: str
    action: Callable[[], Any]
    after: Sequence[str] = ()
    run_if: str = "all_success"


@dataclass
class Outcome:
    states: dict[str, str] = field(default_factory=dict)
    results: dict[str, Any] = field(default_factory=dict)
    errors: dict[str, Exception] = field(default_factory=dict)

    def raise_errors(self) -> None:
        if self.errors:
            raise ExceptionGroup("tasks failed", list(self.errors.values()))


def run_graph(tasks: Sequence[Task], on_success: Callable[[str, Any], None] | None = None) -> Outcome:
    """Run tasks in an order that their `after` allows; errors are collected, not raised. on_success is told of each success."""
    by_name = {t.name: t for t in tasks}
    if unknown := sorted({a for t in tasks for a in t.after if a not in by_name}):
        raise ValueError(f"no such tasks: {unknown}")
    outcome = Outcome()
    for name in TopologicalSorter({t.name: t.after for t in tasks}).static_order():
        task = by_name[name]
        if task.run_if == "all_success" and any(outcome.states[a] != "SUCCESS" for a in task.after):
            outcome.states[name] = "SKIPPED"
            continue
        try:
            outcome.results[name] = task.action()
            if on_success:
                on_success(name, outcome.results[name])
            outcome.states[name] = "SUCCESS"
        except Exception as error:
            log.warning("task %s failed: %s", name, error)
            outcome.states[name], outcome.errors[name] = "FAILED", error
    return outcome


def feature_tasks(spark: SparkSession, store: FeatureStore, sf_dir: str, registered: FeatureStore | None = None, **params: Any) -> list[Task]:
    """The graph of all feature tables; where a second store is given, registrations are copied there at the end."""

    def task(name: str, *after: str) -> Task:
        return Task(name, lambda: run_feature(spark, store, {"env": "dev", "feature": name, **params}, sf_dir), after, "all_done")

    tasks = [
        task("fs_cus_demographic"),
        task("fs_cus_credit_risk", "fs_cus_demographic"),
        task("fs_cus_holding_products"),
        task("fs_cus_payment_behavior", "fs_cus_holding_products"),
        task("fs_cus_transactions", "fs_cus_holding_products"),
    ]
    if registered is not None:
        tasks.append(Task("registry", lambda: store.registry.sync(registered.registry), [t.name for t in tasks], "all_done"))
    return tasks


#: States in which a task is done, of which the first is a success.
DONE = ("SUCCESS", "FAILED", "CANCELED", "TIMEDOUT", "SKIPPED", "EXCLUDED", "UPSTREAM_FAILED", "INTERNAL_ERROR")


def find_job(jobs: Iterable[Mapping[str, Any]], name: str, tags: Mapping[str, str]) -> Mapping[str, Any] | None:
    """The first job of that name that has all the tags."""
    return next((job for job in jobs if job["name"] == name and tags.items() <= (job.get("tags") or {}).items()), None)


def task_states(attempts: DataFrame, job: Any, tasks: Sequence[str] = ()) -> DataFrame:
    """task and state in the newest run of a job; of a task that was tried again the newest attempt counts.

    attempts: job, run, task, started, state. Tasks that have not started in that run have no row.
    """
    mine = attempts.where(F.col("job") == F.lit(job))
    mine = mine.where(F.col("task").isin(*tasks)) if tasks else mine
    newest = attempts.where(F.col("job") == F.lit(job)).agg(F.max("run"))
    return mine.where(F.col("run") == newest.scalar()).groupBy("task").agg(F.max_by("state", F.struct("started", "state")).alias("state"))


def watch(states: Callable[[], Mapping[str, str]], tasks: Sequence[str], on_success: Callable[[str], Any], interval: float = 60, give_up: float | None = None, sleep: Callable[[float], Any] = time.sleep) -> Outcome:
    """Asks for the states of tasks until all are done, and tells on_success of each success once.

    A task that ended otherwise, or whose on_success fails, is an error; errors are collected and the others go on. A
    state in DONE ends a task, any other is waited for, up to give_up seconds in all.
    """
    outcome, left, waited = Outcome(), list(tasks), 0.0
    while left:
        now = states()
        for name in [t for t in left if now.get(t) in DONE]:
            left.remove(name)
            outcome.states[name] = now[name]
            if now[name] != DONE[0]:
                outcome.errors[name] = RuntimeError(f"task {name} ended as {now[name]}")
                continue
            try:
                outcome.results[name] = on_success(name)
            except Exception as error:
                log.warning("task %s succeeded but wasn't handled: %s", name, error)
                outcome.errors[name] = error
        if left and give_up is not None and waited >= give_up:
            for name in left:
                outcome.states[name] = "TIMEDOUT"
                outcome.errors[name] = TimeoutError(f"task {name} wasn't done after {waited:.0f} s")
            break
        if left:
            sleep(interval)
            waited += interval
    return outcome
