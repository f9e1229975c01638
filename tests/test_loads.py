"""Loads of odd input: what the route table says and what the target holds."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from record_loader.functions.coerce import flexible_timestamp
from record_loader.functions.names import normalize_name
from record_loader.operators import conform, enforce_constraints, is_transient, quarantine_units, route_batches, select_records
from record_loader.plans import load_batch
from record_loader.sinks import PathTarget, read_routes
from record_loader.sinks import targets as sinks
from record_loader.sources import read_open_records, read_records
from record_loader.sources.files import list_units
from record_loader.spec import ConfigError, LoadOptions, TargetSpec
from record_loader.streaming import batch_loader, redrive
from record_loader.streaming import load as stream

SCHEMA = "id int, name string"
SPEC = TargetSpec.of("t", [("id", "int", True), ("name", "string")])
LOOSE = TargetSpec.of("t", [("id", "int"), ("name", "string")])


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def routes_of(result):
    return {os.path.basename(r.source_id or ""): (r.route, r.rows, r.error) for r in result.units.collect()}


def test_open_units_good_truncated_empty(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    write(src, "good.json", '[{"id": 1}, {"id": 2, "name": "b"}]')
    write(src, "cut.json", '[{"id": 3}, {"id')
    write(src, "none.json", "[]")
    write(src, "empty.json", "")
    for spec in (LOOSE, SPEC):
        target = PathTarget(f"{tmp_dir}/out-{spec is SPEC}")
        got = routes_of(load_batch(read_open_records(spark, src), spec, target, open_records=True, units=list_units(spark, src)))
        assert got == {"good.json": ("success", 2, None), "cut.json": ("failure", 0, "Malformed record"),
                       "none.json": ("success", 0, None), "empty.json": ("success", 0, None)}
        assert sorted(r.id for r in target.read(spark).collect()) == [1, 2]


def test_open_records_by_line(spark, tmp_dir):
    write(f"{tmp_dir}/in", "a.json", '{"id": 1}\n\n{"id": 2, "Name": "b", "more": {"x": 1}}\n')
    write(f"{tmp_dir}/in", "b.json", '{"id": 3}\n{"id": \n')
    target = PathTarget(f"{tmp_dir}/out")
    got = routes_of(load_batch(read_open_records(spark, f"{tmp_dir}/in", lines=True), SPEC, target, open_records=True))
    assert got == {"a.json": ("success", 2, None), "b.json": ("failure", 0, "Malformed record")}


def test_blank_lines_separate_records(spark, tmp_dir):
    write(f"{tmp_dir}/in", "a.json", '{"id": 1, "name": "a"}\n\n   \n{"id": 2, "name": "b"}\n\n')
    write(f"{tmp_dir}/in", "blank.json", "\n\n")
    src, target = f"{tmp_dir}/in", PathTarget(f"{tmp_dir}/out")
    got = routes_of(load_batch(read_records(spark, src, "json", SCHEMA), SPEC, target, units=list_units(spark, src)))
    assert got == {"a.json": ("success", 2, None), "blank.json": ("success", 0, None)}


def test_records_without_a_unit_fail(spark, tmp_dir):
    recs = spark.createDataFrame([(None, 0, 1, "a"), ("u", 0, 2, "b")], f"source_id string, pos long, {SCHEMA}")
    target = PathTarget(f"{tmp_dir}/out")
    got = routes_of(load_batch(recs, SPEC, target))
    assert got[""][:2] == ("failure", 0) and got["u"] == ("success", 1, None)
    assert [r.id for r in target.read(spark).collect()] == [2]
    rows = spark.createDataFrame([(None, 0, "x"), (None, 1, None), ("u", 0, None)], "source_id string, pos long, _error string")
    good, failed = quarantine_units(rows)
    assert [r.source_id for r in good.collect()] == ["u"] and [tuple(r) for r in failed.collect()] == [(None, "x")]
    batches = spark.createDataFrame([(None, -1), (None, 2), (1, 3)], "batch_id long, v int")
    accepted, rejected = enforce_constraints(batches, checks=["v > 0"])
    assert [tuple(r) for r in accepted.collect()] == [(1, 3)] and rejected.count() == 1


@pytest.mark.parametrize("snapshot", ["cache", "rescan"])
def test_units_of_a_null_batch_are_inserted(spark, tmp_dir, snapshot):
    """What is routed success is in the target, also when another unit fails."""
    schema = "source_id string, batch_id long, pos long, id string, name string"
    recs = spark.createDataFrame([("u", None, 0, "1", "a"), ("u", None, 1, "2", "b"), ("v", None, 0, "x", "c"), ("w", 7, 0, "3", "d")], schema)
    target = PathTarget(f"{tmp_dir}/out")
    result = load_batch(recs, SPEC, target, LoadOptions(snapshot=snapshot))
    assert {k: v[:2] for k, v in routes_of(result).items()} == {"u": ("success", 2), "v": ("failure", 0), "w": ("success", 1)}
    assert sorted(r.id for r in target.read(spark).collect()) == [1, 2, 3] and result.rows_inserted == 3


def test_rejected_null_batch_is_not_inserted(spark, tmp_dir):
    schema = "source_id string, batch_id long, pos long, id int, name string"
    for n, spec in enumerate((TargetSpec.of("t", [("id", "int"), ("name", "string")], checks=["id < 5"]),
                              TargetSpec.of("t", [("id", "int"), ("name", "string")], key=("name",), unique_key=True))):
        recs = spark.createDataFrame([("u", None, 0, 9, "a"), ("v", None, 0, 1, "a"), ("w", 7, 0, 3, "a")], schema)
        target = PathTarget(f"{tmp_dir}/out{n}")
        got = routes_of(load_batch(recs, spec, target, LoadOptions(rollback_on_failure=False)))
        assert {k: v[:2] for k, v in got.items()} == {"u": ("failure", 0), "v": ("failure", 0), "w": ("success", 1)}
        assert [r.id for r in target.read(spark).collect()] == [3]


def test_positions_may_be_null(spark, tmp_dir):
    recs = spark.createDataFrame([("u", None, "x", "a"), ("v", None, "1", "b")], "source_id string, pos long, id string, name string")
    assert {k: v[0] for k, v in routes_of(load_batch(recs, SPEC, PathTarget(f"{tmp_dir}/out"))).items()} == {"u": "failure", "v": "success"}


@pytest.mark.parametrize("snapshot", ["cache", "rescan"])
def test_error_of_selected_records_is_kept(spark, tmp_dir, snapshot):
    rows = [("u", 0, [(1, "a"), (2, "b")]), ("v", 0, None)]
    recs = spark.createDataFrame(rows, "source_id string, pos long, inner array<struct<id:int,name:string>>")
    c = conform(select_records(recs, "inner"), LOOSE, LoadOptions(unmatched_field="fail")).collect()
    assert {(r.source_id, r._error) for r in c} == {("u", None), ("v", "No record at path inner")}
    got = routes_of(load_batch(recs, LOOSE, PathTarget(f"{tmp_dir}/out"), LoadOptions(record_path="inner", snapshot=snapshot)))
    assert got == {"u": ("success", 2, None), "v": ("failure", 0, "No record at path inner")}


def test_fields_named_like_meta_columns(spark, tmp_dir):
    write(f"{tmp_dir}/in", "a.json", '{"target": "t", "pos": "7", "arrival": "x", "attempt": "2", "batch_id": "9", "source_id": "s"}\n')
    names = ("target", "pos", "arrival", "attempt", "batch_id", "source_id")
    spec = TargetSpec.of("t", [(n, "string") for n in names])
    target = PathTarget(f"{tmp_dir}/out")
    load_batch(read_records(spark, f"{tmp_dir}/in", "json", ", ".join(f"{n} string" for n in names)), spec, target)
    assert target.read(spark).first().asDict() == {"target": "t", "pos": "7", "arrival": "x", "attempt": "2", "batch_id": "9", "source_id": "s"}


def test_first_broken_constraint_is_the_reason(spark, tmp_dir):
    spec = TargetSpec.of("t", [("id", "int", True), ("name", "string")], checks=["name <> 'z'", "id < 5"])
    recs = spark.createDataFrame([("a", 0, 9, "b"), ("b", 0, 1, "z")], f"source_id string, pos long, {SCHEMA}")
    assert {r.reason for r in load_batch(recs, spec, PathTarget(f"{tmp_dir}/out")).rejected.collect()} == {"CHECK constraint violated: name <> 'z'"}


def test_whole_error_text_is_kept(spark, tmp_dir):
    text = "line one\n" + "x" * 5000 + "\nlast"

    class Broken(PathTarget):
        def append(self, df, opts=None, token=None):
            raise ValueError(text)

    recs = spark.createDataFrame([("a", 0, 9, "b")], f"source_id string, pos long, {SCHEMA}")
    assert routes_of(load_batch(recs, SPEC, Broken(f"{tmp_dir}/out"))) == {"a": ("failure", 0, text)}
    assert route_batches(spark.createDataFrame([("a",)], "source_id string"), ValueError(text)).first().error == text


def test_transient_is_a_class_not_a_word(spark):
    assert not is_transient(ValueError("after a java.sql.SQLTimeoutException: gave up"))
    assert not is_transient(type("NonTransientError", (RuntimeError,), {})("x"))
    assert is_transient(RuntimeError("java.sql.SQLTimeoutException: slow"))
    jvm = spark.sparkContext._jvm

    class Wrapped(RuntimeError):
        def __init__(self, java):
            super().__init__("wrapped")
            self.java_exception = java

    timeout = jvm.java.sql.SQLTimeoutException("slow")
    assert is_transient(Wrapped(timeout)) and is_transient(Wrapped(jvm.java.lang.RuntimeException("job", timeout)))
    assert not is_transient(Wrapped(jvm.java.sql.SQLException("SQLTransientException in the text")))


def test_replay_leaves_one_route_and_no_doubled_row(spark, tmp_dir, monkeypatch):
    """The batch dies after each of its writes in turn and is run again."""
    recs = spark.createDataFrame([("f1", 1, "a"), ("f2", 2, "b")], f"source_id string, {SCHEMA}")
    for k, name in enumerate(("write_routes", "write_receipts")):
        base = f"{tmp_dir}/{k}"
        target = PathTarget(f"{base}/out", idempotent=True)
        run = batch_loader(SPEC, target, LoadOptions(), "t", f"{base}/routes", f"{base}/receipts")
        real = getattr(stream, name)
        for before in (True, False):
            def dying(*a, before=before, real=real, **b):
                if not before:
                    real(*a, **b)
                raise RuntimeError("killed")
            monkeypatch.setattr(stream, name, dying)
            with pytest.raises(RuntimeError, match="killed"):
                run(recs, 7)
            monkeypatch.setattr(stream, name, real)
            if name == "write_receipts" and not before:
                break
        run(recs, 7)
        run(recs, 7)
        assert sorted(r.id for r in target.read(spark).collect()) == [1, 2]
        assert read_routes(spark, f"{base}/routes").count() == 2 and stream.read_receipts(spark, f"{base}/receipts").count() == 2


def test_a_store_that_cannot_be_read_is_not_taken_for_uncommitted(spark, tmp_dir):
    write(f"{tmp_dir}/receipts/load_name=t/batch_id=1", "part-0.parquet", "not parquet")
    assert stream._committed(spark, f"{tmp_dir}/receipts", "t", 1)
    assert not stream._committed(spark, f"{tmp_dir}/receipts", "t", 2)
    with pytest.raises(Exception) as e:
        stream._committed(spark, "nosuchstore://x/receipts", "t", 1)
    assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"


def test_redrive_of_paths_with_odd_characters(spark, tmp_dir):
    src = f"{tmp_dir}/in dir"
    write(src, "a b [1] 100%.json", '{"id": 1, "name": "a"}\n')
    units = read_records(spark, src.replace(" ", " "), "json", SCHEMA).select("source_id").distinct()
    routes = f"{tmp_dir}/routes"
    sinks.write_routes(units.select("source_id", F.lit("retry").alias("route"), F.lit(0).alias("rows"), F.lit("x").alias("error"),
                                    F.lit("d").alias("destination"), F.lit(1).alias("attempt")), routes, "t", 0)
    target = PathTarget(f"{tmp_dir}/out")
    redrive(spark, routes, SCHEMA, SPEC, target, LoadOptions(), "t")
    assert [r.id for r in target.read(spark).collect()] == [1]


def test_time_alone_is_no_timestamp(spark):
    rows = spark.createDataFrame([("12:30:00",), ("2024-02-06T11:51:28Z",), ("2024-02",)], "s string")
    value, error = flexible_timestamp(F.col("s"))
    got = rows.select(value.alias("v"), error.alias("e")).collect()
    assert got[0].v is None and got[0].e and got[1].v is not None and got[2].v is not None


def test_uuid_columns(spark):
    spec = TargetSpec.of("t", [("id", "uuid"), ("name", "string")])
    rows = spark.createDataFrame([("u", 0, "5bbbee50-b7e0-4a8f-8d0d-5b0c8a0d6c11", "a"), ("v", 0, "nope", "b")], "source_id string, pos long, id string, name string")
    got = {r.source_id: (r.id, r._error) for r in conform(rows, spec).collect()}
    assert got["u"] == ("5bbbee50-b7e0-4a8f-8d0d-5b0c8a0d6c11", None) and got["v"][0] is None and got["v"][1]


def test_names_follow_one_regex_engine(spark):
    assert normalize_name("first-name.x", "PATTERN", r"\p{Punct}") == "FIRSTNAMEX"


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        master, _jsc = "spark://host:7077", spark.sparkContext._jsc

    class Session:
        sparkContext = Cluster()

        class conf:
            @staticmethod
            def get(key, default=None):
                return None

    class Unset:
        def isDefined(self):
            return False

    class Context:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return Unset()

    Cluster._jsc = Context()
    with pytest.raises(ConfigError):
        sinks.shared_dir(Session())
