"""Snapshots, evolution, registry, quality checks, steps, jobs and streams."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.plans import jobs, steps
from tidemark.quality import checks
from tidemark.quality.ledger import Ledger
from tidemark.sources.layers import Layers, from_rows, path_exists, select_datasets
from tidemark.store.evolution import MissingColumnsError, compare, decide
from tidemark.store.feature_store import FeatureStore, FeatureTable, check_sources
from tidemark.store.snapshots import ConcurrentCommitError, DuplicateKeysError, SnapshotTable
from tidemark.streaming.sinks import merge_sink, windowed_counts

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def root(tmp_path):
    return f"file:{tmp_path}/{uuid.uuid4().hex}"


def frame(spark, rows, schema="k int, d date, v int"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


D = dt.date


def test_versions_and_time_travel(spark, root):
    table = SnapshotTable(spark, root)
    assert not table.exists() and table.schema() is None
    with pytest.raises(LookupError):
        table.read()
    table.overwrite(frame(spark, [(1, D(2024, 1, 1), 5)]), properties={"a": 1})
    middle = dt.datetime.now(dt.UTC)
    table.append(frame(spark, [(2, D(2024, 2, 1), 6)]))
    assert table.versions() == [0, 1] and table.read(0).count() == 1 and table.read().count() == 2
    assert table.version_as_of(middle) == 0
    assert table.set_properties({"a": 1, "b": [2]}) == {"b": [2]} and table.manifest()["properties"] == {"a": 1, "b": [2]}
    table.compact(1)
    assert table.vacuum(1) == [0, 1] and table.versions() == [2] and table.read().count() == 2


def test_concurrent_commit(spark, root, monkeypatch):
    table, other = SnapshotTable(spark, root), SnapshotTable(spark, root)
    monkeypatch.setattr(other, "exists", lambda: False)
    table.overwrite(frame(spark, [(1, None, 1)]))
    with pytest.raises(ConcurrentCommitError):
        other.overwrite(frame(spark, [(2, None, 2)]))
    assert rows(table.read()) == [(1, None, 1)]


def test_merge_modes(spark, root):
    first = frame(spark, [(1, D(2024, 1, 1), 5), (2, D(2024, 1, 1), 6)])
    second = frame(spark, [(2, D(2024, 1, 1), 60, "n"), (3, D(2024, 1, 1), 7, "m")], "k int, d date, v int, x string")
    for mode, kept in (("insert_only", 6), ("upsert", 60)):
        table = SnapshotTable(spark, f"{root}/{mode}")
        table.overwrite(first)
        table.merge(second, ["k", "d"], mode)
        assert rows(table.read()) == [(1, D(2024, 1, 1), 5, None), (2, D(2024, 1, 1), kept, "n"), (3, D(2024, 1, 1), 7, "m")]
    with pytest.raises(ValueError):
        table.merge(second, ["k"], "x")
    with pytest.raises(KeyError):
        table.merge(second, ["zz"])


def test_partition_modes(spark, root):
    table = SnapshotTable(spark, root)
    table.replace_partitions(frame(spark, [(1, D(2024, 1, 1), 5), (2, D(2024, 2, 1), 6)]), "d")
    table.replace_partitions(frame(spark, [(9, D(2024, 2, 1), 7)]), "d")
    assert {(r.k, r.v) for r in table.read().collect()} == {(1, 5), (9, 7)}
    table.insert_unseen(frame(spark, [(8, D(2024, 2, 1), 0), (7, D(2024, 3, 1), 1)]), "d")
    assert {r.k for r in table.read().collect()} == {1, 9, 7}
    assert "PartitionFilters: [isnotnull(d" in table.read().where("d = date'2024-03-01'")._jdf.queryExecution().executedPlan().toString()


def test_duplicate_keys_are_refused(spark, root):
    table = SnapshotTable(spark, root)
    table.overwrite(frame(spark, [(1, None, 1), (2, None, 2)]))
    twice = frame(spark, [(1, None, 10), (1, None, 11), (3, None, 3), (3, None, 4)])
    for mode in ("insert_only", "upsert"):
        with pytest.raises(DuplicateKeysError):
            table.merge(twice, ["k"], mode)
    assert table.versions() == [0] and rows(table.read()) == [(1, None, 1), (2, None, 2)]
    table.merge(frame(spark, [(None, None, 5), (None, None, 5)]), ["k"], "upsert")  # a null key is like no other
    assert table.read().count() == 4
    store = FeatureStore(spark, f"{root}-store")
    with pytest.raises(DuplicateKeysError):
        store.save(definition(), frame(spark, [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 1), 6)]))
    assert not store.table("t").exists() and store.registry.names() == []


def data_files(table):
    return set(table._files.below(f"{table.path}/data"))


def test_commits_write_only_what_changes(spark, root):
    table = SnapshotTable(spark, root)
    table.overwrite(frame(spark, [(k, D(2024, 1 + k % 4, 1), k) for k in range(40)]).repartitionByRange(8, "k"))
    first = data_files(table)
    table.append(frame(spark, [(100, None, 1)]).coalesce(1))
    assert len(data_files(table) - first) == 1 and len(first) == 8
    before = data_files(table)
    version = table.merge(frame(spark, [(3, D(2025, 1, 1), -3), (200, None, 7)]), ["k"], "upsert")
    live = table.manifest(version)["batches"]
    kept = [f for batch, files in live.items() for f in (files or table._files.below(table._folder(batch)))]
    assert sum(len(files) for files in live.values() if files) == 7  # of the first eight files one was rewritten
    assert before <= data_files(table) and len(kept) < len(data_files(table))
    assert {r.k: r.v for r in table.read().collect()} == {k: k for k in range(40)} | {100: 1, 3: -3, 200: 7}
    assert {r.k: r.v for r in table.read(version - 1).collect()} == {k: k for k in range(40)} | {100: 1}
    known = table.manifest()["batches"]
    table.merge(frame(spark, [(3, None, 0), (201, None, 9)]), ["k"])  # nothing stored changes, so nothing is rewritten
    assert known.items() <= table.manifest()["batches"].items() and table.read().count() == 43
    table.merge(frame(spark, [(5, "x"), (300, "y")], "k int, note string"), ["k"])
    assert {r.k: r.note for r in table.read().where("note is not null").collect()} == {5: "x", 300: "y"}
    table.vacuum(1)
    assert data_files(table) == {f"batch__={b}/{f}" for b, files in table.manifest()["batches"].items() for f in (files or table._files.below(table._folder(b)))}
    assert table.read().count() == 44


def test_partitions_with_odd_names(spark, root):
    table = SnapshotTable(spark, root)
    names = ["1-URGENT", "a b/c%é=x", "", None, "x:y"]
    schema = "p string, k int"
    table.overwrite(frame(spark, [(p, k) for k, p in enumerate(names)], schema), ["p"])
    files = data_files(table)
    table.replace_partitions(frame(spark, [("a b/c%é=x", 10), ("a b/c%é=x", 11)], schema).coalesce(1), "p")
    assert len(data_files(table) - files) == 1
    assert {r.k for r in table.read().collect()} == {0, 2, 3, 4, 10, 11}
    table.merge(frame(spark, [("x:y", 4), ("1-URGENT", 50)], schema), ["k"], "upsert")
    assert {r.k for r in table.read().collect()} == {0, 2, 3, 4, 10, 11, 50}
    table.vacuum(1)
    assert {(r.p or "", r.k) for r in table.read().collect()} == {("1-URGENT", 0), ("a b/c%é=x", 10), ("a b/c%é=x", 11), ("", 2), ("", 3), ("x:y", 4), ("1-URGENT", 50)}


def test_evolution(spark):
    diff = compare(frame(spark, []).schema, frame(spark, [], "k int, v string, n int").schema)
    assert (diff.new_columns, diff.missing_columns, diff.changed_types) == (["n"], ["d"], {"v": ("int", "string")})
    assert bool(diff) and not compare(None, frame(spark, []).schema) and len(diff.warnings()) == 3
    assert decide(diff, "overwrite") == "overwrite" and decide(diff, lambda d: "ignore") == "ignore"
    with pytest.raises(MissingColumnsError):
        decide(diff, "raise")
    with pytest.raises(ValueError):
        decide(diff, "x")


def definition(name="t"):
    return FeatureTable(name, "about it", ["k", "d"], ["d"])


def test_definitions():
    with pytest.raises(ValueError) as error:
        FeatureTable(" ", "", [], ["d", " "])
    assert all(word in str(error.value) for word in ("name", "description", "primary_keys", "timestamp_keys"))
    with pytest.raises(ValueError):
        FeatureTable("t", "x", ["k"], ["d"])


def test_store(spark, root):
    store = FeatureStore(spark, root)
    full = frame(spark, [(1, D(2024, 1, 1), 5), (1, D(2024, 3, 1), 6)])
    assert store.save(definition(), full)["operation"] == "overwrite"
    with pytest.raises(MissingColumnsError):
        store.save(definition(), full.drop("v"))
    saved = store.save(definition(), full.drop("v").withColumn("d", F.lit("2024-04-01").cast("date")).distinct(), on_missing="ignore")
    assert saved["schema_changed"] and rows(store.read("t")) == [(1, D(2024, 1, 1), 5), (1, D(2024, 3, 1), 6), (1, D(2024, 4, 1), None)]
    assert store.save(definition(), full, force_overwrite=True)["operation"] == "overwrite"
    labels = frame(spark, [(1, D(2024, 2, 15)), (1, D(2023, 12, 1)), (1, D(2024, 3, 1)), (2, D(2024, 3, 1))], "c int, at date")
    assert rows(store.lookup(labels, "t", ["c"], "at")) == [(1, D(2023, 12, 1), None), (1, D(2024, 2, 15), 5), (1, D(2024, 3, 1), 6), (2, D(2024, 3, 1), None)]
    with pytest.raises(LookupError):
        store.lookup(labels, "zz", ["c"], "at")
    other = FeatureStore(spark, f"{root}-other")
    assert store.registry.sync(other.registry) == {"t": {"added": [], "removed": []}} and other.registry.names() == ["t"]
    assert store.registry.sync(other.registry) == {}


def test_source_checks(spark):
    with pytest.raises(ValueError) as error:
        check_sources(spark, ["bare", "default.nothing", "nodb.t"])
    assert str(error.value).count(";") == 2


def test_freshness(spark):
    df = frame(spark, [(1, D(2024, 1, 20), 0), (2, None, 0)])
    at = lambda as_of, shift=0: checks.freshness(df, "t", "d", as_of, shift).first()
    assert (at("2024-01-31")["outdated"], at("2024-02-01")["outdated"], at("2024-02-01", 1)["outdated"]) == (False, True, False)
    assert at("2024-04-10")["months_behind"] == 3
    assert checks.freshness(df.where("d is null"), "t", "d", "2024-01-01").first()["outdated"]
    with pytest.raises(checks.StaleDataError):
        checks.require_fresh(checks.freshness(df, "t", "d", "2024-04-01"))
    codes = spark.createDataFrame([("2024-01-q2", 2023)], "q string, y int")
    assert codes.select(checks.parsed_date("q", "yyyy-mm-qq"), checks.parsed_date("y", "yyyy")).first()[:] == (D(2024, 1, 16), D(2023, 12, 1))


def test_validation_and_ledger(spark, root):
    df = frame(spark, [(k, D(2024, m, 1), 0) for k in range(5) for m in (1, 2, 4)])
    verdict = checks.validate(df, "t", "ingestion", "d", "2024-04-02", df.where("k != 1 or month(d) != 2"), ["k", "zz"], ignore=["MISSING_COLUMNS"])
    assert set(verdict.failed) == {"MISSING_COLUMNS", "MONTHLY_VAL", "CROSS_CHECKING"} and not verdict.ok
    assert verdict.failed["CROSS_CHECKING"][0]["diff"] == 1
    assert checks.validate(df, "t", "ingestion", None, "2024-04-02", df.limit(14), tolerance=0.1).ok
    assert not checks.validate(df, "t", "ingestion", None, "2024-04-02", df.limit(0)).ok
    ledger = Ledger(spark, root)
    assert ledger.last("t", "ingestion") is None and not ledger.passed("t", "ingestion")
    ledger.register(verdict, "db", "t", "ingestion", dt.datetime(2024, 1, 1), mode="validate")
    assert ledger.read().count() == 0
    ledger.register(verdict, "db", "t", "ingestion", dt.datetime(2024, 1, 1))
    ledger.register(checks.Verdict(), "db", "t", "ingestion", dt.datetime(2024, 1, 2))
    assert ledger.passed("t", "ingestion") and ledger.read("detail").count() == 8
    assert ledger.read("detail").where("check = 'MISSING_COLUMNS' and state = 'FAILED' and ignore").count() == 1


def test_layers(spark, root):
    df = frame(spark, [(1, None, 2)])
    df.write.parquet(f"{root}/pre")
    layers = Layers(spark, {"a": {"source": f"{root}/pre", "preprocessing_path": f"{root}/pre"}, "b": {"source": "default.nothing"}})
    assert rows(layers.read("a")) == rows(layers.read("a", "preprocessing", "parquet")) == rows(df)
    with pytest.raises(ValueError):
        layers.read("a", "preprocessing")
    assert layers.exists("a", "source") and not layers.exists("b", "source") and not path_exists(spark, f"{root}/none")
    assert select_datasets({"a": 1, "b": 2}, "*", ["a"]) == ["b"] and select_datasets({"a": 1, "b": 2}, ["b", "a"]) == ["a", "b"]
    with pytest.raises(KeyError):
        select_datasets({"a": 1}, ["z"])
    assert from_rows(spark, [(1,)], "k int").count() == 1


def test_steps(spark):
    df = frame(spark, [(1, None, 2), (2, None, 3)])
    plan = [
        {"step": "filter_by_conditions", "params": {"conditions": ["k = 1"]}, "as": "one"},
        {"step": "exclude_ids", "on": "whole", "frames": {"excluded": "one"}, "params": {"columns": ["k"]}},
    ]
    assert rows(steps.run(df, plan, whole=df)) == [(2, None, 3)]
    with pytest.raises(ValueError) as error:
        steps.check([{"step": "nope"}, {"step": "drop_na"}, {"step": "impute", "params": {"valu": 1}}, {"step": "drop_na", "on": "zz", "params": {"subset": "k"}}])
    assert str(error.value).count("step ") == 4


def test_params():
    good = jobs.checked_params({"env": "dev", "feature": "fs_cus_transactions", "end_date": "actual", "force_overwrite": "True"}, dt.date(2024, 5, 9))
    assert good["end_date"] == "2024-05-01" and good["force_overwrite"] is True
    with pytest.raises(ValueError) as error:
        jobs.checked_params({"feature": "x", "force_overwrite": "maybe", "start_date": "soon"})
    assert str(error.value).count(";") == 3


def test_graph():
    ran = []
    boom = lambda: 1 / 0
    tasks = [jobs.Task("a", boom), jobs.Task("b", lambda: ran.append("b"), ["a"]), jobs.Task("c", lambda: ran.append("c"), ["a", "b"], "all_done")]
    told = []
    outcome = jobs.run_graph(tasks, lambda name, _: told.append(name))
    assert outcome.states == {"a": "FAILED", "b": "SKIPPED", "c": "SUCCESS"} and ran == told == ["c"]
    with pytest.raises(ExceptionGroup):
        outcome.raise_errors()
    with pytest.raises(ValueError):
        jobs.run_graph([jobs.Task("a", boom, ["zz"])])


def test_feature_jobs(spark, root):
    store, copy = FeatureStore(spark, root), FeatureStore(spark, f"{root}-copy")
    outcome = jobs.run_graph(jobs.feature_tasks(spark, store, SF, copy, start_date="1996-01-01", end_date="1997-01-01"))
    outcome.raise_errors()
    assert set(outcome.states.values()) == {"SUCCESS"} and copy.registry.names() == sorted(jobs.BUILDERS)
    for name in jobs.BUILDERS:
        assert store.read(name).columns == jobs.features.SPECS[name].output_columns
    again = jobs.run_feature(spark, store, {"env": "dev", "feature": "fs_cus_transactions"}, SF)
    assert again["operation"] == "merge" and store.read("fs_cus_transactions", 0).count() == store.read("fs_cus_transactions").count()
    with pytest.raises(RuntimeError):
        jobs.run_feature(spark, store, {"env": "dev", "feature": "fs_cus_transactions"}, "/nowhere")


def test_streams(spark, root, tmp_path):
    source = tmp_path / "in"
    frame(spark, [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 2), 6), (2, D(2024, 1, 1), 7)]).coalesce(1).write.parquet(str(source))
    table = lambda: SnapshotTable(spark, root)
    stream = spark.readStream.schema("k int, d date, v int").parquet(str(source))
    for _ in range(2):
        writer = merge_sink(stream, table, ["k"], newest_by="d").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True)
        writer.start().awaitTermination()
        frame(spark, [(2, D(2024, 1, 5), 8)]).coalesce(1).write.mode("append").parquet(str(source))
    assert rows(table().read()) == [(1, D(2024, 1, 2), 6), (2, D(2024, 1, 5), 8)]
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "a", 1.5), (dt.datetime(2024, 1, 1, 9), "a", 2.0), (dt.datetime(2024, 1, 2), "b", 1.0)], "ts timestamp, kind string, x double")
    got = windowed_counts(events, "ts", ["kind"], value="x")
    assert sorted((r.kind, r.n, r.x_sum) for r in got.collect()) == [("a", 2, 3.5), ("b", 1, 1.0)]


def test_debugging(spark, caplog):
    import io
    import logging

    from tidemark.plans import debug

    text = io.StringIO()
    logger = debug.colour_logger("tidemark.debug", stream=text)
    assert len(debug.colour_logger("tidemark.debug", stream=text).handlers) == 1
    make = debug.logs_columns(lambda: frame(spark, [(1, None, 2)]))
    assert make().count() == 1 and debug.logs_shape(count=True)(make)().count() == 1
    assert debug.logs_shape()(lambda: 7)() == 7
    lines = text.getvalue().splitlines()
    assert len(lines) == 3 and all(line.startswith("\033[34m") and line.endswith("\033[0m") for line in lines) and "1 rows, 3 columns" in lines[-1]
    logger.log(logging.DEBUG + 15, "plain")
    assert "\033" not in text.getvalue().splitlines()[-1]


def test_rest_source(spark):
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from tidemark.sources.rest import RestSource

    class Service(BaseHTTPRequestHandler):
        def do_GET(self):
            page = int(self.path.rpartition("=")[2])
            found = self.headers["Authorization"] == "Bearer t"
            self.send_response(200 if found else 401)
            self.end_headers()
            self.wfile.write(json.dumps({"jobs": [{"job_id": 10 * page + k, "name": f"j{k}", "tags": {"a": page}} for k in range(2)]}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(RestSource)
    reader = spark.read.format("rest").schema("job_id bigint, name string, tags string, more int").options(url=f"http://127.0.0.1:{server.server_port}/jobs?page={{page}}", pages=2, field="jobs")
    assert rows(reader.option("token", "t").load()) == [(0, "j0", '{"a": 0}', None), (1, "j1", '{"a": 0}', None), (10, "j0", '{"a": 1}', None), (11, "j1", '{"a": 1}', None)]
    with pytest.raises(Exception, match="401"):
        reader.option("token", "x").load().collect()
    server.shutdown()


def test_watch_ends():
    told = []
    outcome = jobs.watch(lambda: {"a": "RUNNING", "b": "SUCCESS"}, ["a", "b"], told.append, interval=5, give_up=10, sleep=lambda _: None)
    assert outcome.states == {"b": "SUCCESS", "a": "TIMEDOUT"} and told == ["b"] and isinstance(outcome.errors["a"], TimeoutError)
    outcome = jobs.watch(lambda: {"a": "SUCCESS"}, ["a"], lambda name: 1 / 0, sleep=lambda _: None)
    assert isinstance(outcome.errors["a"], ZeroDivisionError)
