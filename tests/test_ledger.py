"""Commit ledger (K2, X1), merge into a stored target (W1), stored keys (F3), per-target routes (K4), re-drive."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from record_loader import LoadOptions, TargetSpec
from record_loader.plans import load_batch, load_per_target
from record_loader.sinks import LedgerTarget, MergeTarget, PathTarget, read_routes
from record_loader.streaming import load as stream
from record_loader.streaming import load_directory, read_receipts, read_record_stream, redrive, stream_load
from record_loader.streaming.recipes import FlakyTarget

SPEC = TargetSpec.of("persons", [("id", "int", True), ("name", "string")], key=("id",))
SCHEMA = "id int, name string"


def put(folder, name, *ids):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.writelines(json.dumps({"id": i, "name": f"n{i}"}) + "\n" for i in ids)


def ids(target, spark):
    return sorted(r.id for r in target.read(spark).collect())


@pytest.mark.parametrize("kind", ["ledger", "folder", "plain"])
def test_used_load_name_with_a_new_checkpoint_loses_nothing(spark, tmp_dir, kind):
    path = f"{tmp_dir}/out"
    target = LedgerTarget(path) if kind == "ledger" else PathTarget(path, idempotent=kind == "folder")
    put(f"{tmp_dir}/a", "f1.json", 1)
    put(f"{tmp_dir}/a", "f2.json", 2)
    put(f"{tmp_dir}/b", "f3.json", 3)
    for k, src in enumerate("aba"):
        load_directory(spark, f"{tmp_dir}/{src}", SPEC, target, LoadOptions(max_units=1), f"{tmp_dir}/ckpt{min(k, 1) if src == 'b' else 0}", "used", schema=SCHEMA,
                       routes_path=f"{tmp_dir}/routes", receipts_path=f"{tmp_dir}/receipts")
    assert ids(target, spark) == [1, 2, 3]
    assert read_receipts(spark, f"{tmp_dir}/receipts").count() == read_routes(spark, f"{tmp_dir}/routes").count() == 3
    assert read_receipts(spark, f"{tmp_dir}/receipts").select("run").distinct().count() == 2


@pytest.mark.parametrize("death", ["stage", "commit", "write_routes", "write_receipts"])
@pytest.mark.parametrize("after", [False, True])
def test_death_around_every_write(spark, tmp_dir, monkeypatch, death, after):
    """The driver dies before or after each of a micro-batch's writes; the restart loads every record once."""
    target = LedgerTarget(f"{tmp_dir}/out")
    for k in range(3):
        put(f"{tmp_dir}/in", f"f{k}.json", 10 * k, 10 * k + 1)
    owner = target if death in ("stage", "commit") else stream
    real, deaths = getattr(owner, death), [1]

    def dying(*args, **kw):
        if deaths and not after:
            raise RuntimeError(f"died before {death} {deaths.pop()}")
        out = real(*args, **kw)
        if deaths:
            raise RuntimeError(f"died after {death} {deaths.pop()}")
        return out

    monkeypatch.setattr(owner, death, dying)

    def run():
        q = stream_load(read_record_stream(spark, f"{tmp_dir}/in", SCHEMA, max_units=1), SPEC, target, LoadOptions(), f"{tmp_dir}/ckpt", "l",
                        routes_path=f"{tmp_dir}/routes", receipts_path=f"{tmp_dir}/receipts", on_failure="rollback")
        q.awaitTermination()

    with pytest.raises(Exception, match="died"):
        run()
    run()
    assert ids(target, spark) == [0, 1, 10, 11, 20, 21]
    for df in (read_receipts(spark, f"{tmp_dir}/receipts"), read_routes(spark, f"{tmp_dir}/routes")):
        assert sorted(r.rows for r in df.collect()) == [2, 2, 2]
    assert target.recover(spark) == 0  # too young
    assert target.recover(spark, 0) == ((death, after) in (("stage", True), ("commit", False)))
    assert ids(target, spark) == [0, 1, 10, 11, 20, 21]


def test_ledger_target_without_loads_and_names(spark, tmp_dir):
    target = LedgerTarget(f"{tmp_dir}/out")
    with pytest.raises(LookupError):
        target.read(spark)
    assert target.read(spark, SCHEMA).count() == 0
    assert target.append(spark.createDataFrame([(1, "a")], SCHEMA), token="odd name/with=signs") == 1
    assert target.append(spark.createDataFrame([(2, "b")], SCHEMA), token="odd name/with=signs") == 1
    assert target.append(spark.createDataFrame([], SCHEMA), token="2024-01-01") == 0
    assert target.append(spark.createDataFrame([(3, "c")], SCHEMA)) == 1
    assert ids(target, spark) == [1, 3]
    with pytest.raises(ValueError):
        target.append(spark.createDataFrame([(1,)], "load_try int"))


def test_merge_rewrites_only_touched_buckets(spark, tmp_dir):
    target = MergeTarget(f"{tmp_dir}/out", key=("id",), version=("v",), buckets=8)
    rows = spark.range(100).select(F.col("id").cast("int").alias("id"), F.lit(1).alias("v"), F.lit("old").alias("name"))
    assert target.append(rows, token="a") == 100
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_dir}/out/data/**/*.parquet", recursive=True)}
    new = spark.createDataFrame([(1, 2, "new"), (2, 0, "late"), (3, 1, "tie"), (None, 1, "null key"), (None, 3, "null key again")], "id int, v int, name string")
    target.append(new, token="b")
    target.append(new.where("false"), token="none")
    assert target.append(new.withColumn("name", F.lit("again")), token="b") == target.committed(spark, "b")
    got = {r.id: r.name for r in target.read(spark).collect()}
    assert (len(got), got[1], got[2], got[3], got[None], got[50]) == (101, "new", "old", "tie", "null key again", "old")
    assert all(os.stat(f).st_mtime_ns == t for f, t in files.items())
    touched = {r[0] for r in new.select(F.pmod(F.xxhash64("id"), F.lit(8)).cast("int")).collect()}
    made = {int(f.split("load_bucket=")[1].split("/")[0]) for f in glob.glob(f"{tmp_dir}/out/data/**/*.parquet", recursive=True) if f not in files}
    assert made == touched and len(touched) < 8
    assert target.recover(spark, 0) == 0  # the first load still holds the other buckets
    assert len(target.read(spark).collect()) == 101


@pytest.mark.parametrize("kind", ["ledger", "folder", "plain"])
def test_keys_that_the_target_holds(spark, tmp_dir, kind):
    spec = TargetSpec.of("persons", SPEC.columns, key=("id",), unique_key=True)
    path = f"{tmp_dir}/out"
    target = LedgerTarget(path) if kind == "ledger" else PathTarget(path, idempotent=kind == "folder")
    rows = [("u", 0, 1, "a"), ("u", 1, 2, "b"), ("w", 0, 3, "c")]
    make = lambda rs: spark.createDataFrame(rs, "source_id string, pos long, id int, name string")
    first = load_batch(make(rows), spec, target, token="t0")
    assert {r.route for r in first.units.collect()} == {"success"}
    second = load_batch(make([("x", 0, 4, "d"), ("y", 0, 2, "again")]), spec, target, token="t1")
    assert {(r.source_id, r.route, r.error) for r in second.units.collect()} == {(u, "failure", "key (id) is stored already") for u in "xy"}
    assert {r.route for r in load_batch(make([("x", 0, 4, "d")]), spec, target, token="t2").units.collect()} == {"success"}
    assert ids(target, spark) == [1, 2, 3, 4]
    if kind != "plain":  # a replay meets its own rows and is no conflict
        assert {r.route for r in load_batch(make(rows), spec, target, token="t0").units.collect()} == {"success"}
        assert ids(target, spark) == [1, 2, 3, 4]


@pytest.mark.parametrize("kind", ["ledger", "plain"])
def test_keys_are_checked_once(spark, tmp_dir, kind):
    """Every load with a unique key converts its records once, its routes included, and one without a conflict joins nothing."""
    spec = TargetSpec.of("persons", SPEC.columns, key=("id",), unique_key=True)
    target = LedgerTarget(f"{tmp_dir}/out") if kind == "ledger" else PathTarget(f"{tmp_dir}/out")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def load(token, *rows):
        made = spark.createDataFrame(rows, "source_id string, pos long, id int, name string, batch_id long")
        before = seen.value
        result = load_batch(made.mapInArrow(counted, made.schema), spec, target, token=token)
        routes = {(r.source_id, r.route, r.rows, r.error) for r in result.units.collect()}
        assert {r.batch_id: r.reason for r in result.rejected.collect()} == {r[4]: e for r in rows for u, _, _, e in routes if u == r[0] and e and "unit" not in e}
        assert seen.value - before == len(rows)
        return result, routes

    result, routes = load("t0", ("u", 0, 1, "a", 0), ("u", 1, 2, "b", 0), ("w", 0, 3, "c", None))
    assert routes == {("u", "success", 2, None), ("w", "success", 1, None)}
    assert "Join" not in result.loaded._jdf.queryExecution().optimizedPlan().toString()
    stored, twice, null = "key (id) is stored already", "duplicate key (id)", "NOT NULL constraint violated: id"
    _, routes = load("t1", ("a", 0, 2, "x", 0), ("b", 0, 4, "x", 0), ("c", 0, 5, "x", 1), ("d", 0, 6, "x", None), ("e", 0, 6, "x", None), ("f", 0, None, "x", 2))
    assert routes == {("a", "failure", 0, stored), ("b", "failure", 0, stored), ("c", "success", 1, None), ("d", "failure", 0, twice), ("e", "failure", 0, twice), ("f", "failure", 0, null)}
    _, routes = load("t2", (None, 0, 1, "x", 0), ("k", 0, 7, "x", 0))                 # a failed unit takes its keys with it
    assert routes == {(None, "failure", 0, "Record has no unit (source_id is NULL)"), ("k", "success", 1, None)}
    assert ids(target, spark) == [1, 2, 3, 5, 7]


def test_every_unit_of_a_per_target_load_is_loaded_or_routed(spark, tmp_dir):
    recs = spark.createDataFrame([("a", 0, 1, "x"), (None, 0, 2, "y"), ("stray", 0, 3, "z"), ("twice", 0, 4, "w"), ("torn", 0, 5, "v"), ("blank", 0, 6, "u")],
                                 "source_id string, pos long, id int, name string")
    units = spark.createDataFrame([("a", "T1"), ("twice", "T1"), ("twice", "T1"), ("torn", "T1"), ("torn", "T2"), ("blank", None)], "source_id string, table string")
    t1 = PathTarget(f"{tmp_dir}/t1")
    results, missing = load_per_target(recs, units, "${table}", {"T1": (SPEC, t1)})
    assert ids(t1, spark) == [1, 4]
    assert {r.source_id: r.route for r in results["T1"].units.collect()} == {"a": "success", "twice": "success"}
    lost = {r.source_id: r.error for r in missing.collect()}
    assert lost == {None: "Record has no unit (source_id is NULL)", "stray": "Unit is not in the unit table",
                    "torn": "Unit names two targets: T1, T2", "blank": "Target table name is blank"}


@pytest.mark.parametrize("own_routes", [False, True])
def test_second_redrive_has_nothing_to_do(spark, tmp_dir, own_routes):
    for k in (1, 2):
        put(f"{tmp_dir}/in", f"f{k}.json", k)
    target = PathTarget(f"{tmp_dir}/out")
    routes, receipts = f"{tmp_dir}/routes", f"{tmp_dir}/receipts"
    load_directory(spark, f"{tmp_dir}/in", SPEC, FlakyTarget(target, 99), LoadOptions(), f"{tmp_dir}/ckpt", "r", schema=SCHEMA, routes_path=routes, receipts_path=receipts)
    again = {"new_routes_path": f"{tmp_dir}/again"} if own_routes else {}
    calls = [len(redrive(spark, routes, SCHEMA, SPEC, target, LoadOptions(), "r2", receipts_path=receipts, **again)) for _ in range(3)]
    assert calls == [1, 0, 0] and ids(target, spark) == [1, 2]


def test_redrive_with_reader_options_and_open_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/a.csv", "w") as f:
        f.write("id;name\n1;x\n2;y\n")
    out = PathTarget(f"{tmp_dir}/out")
    load_directory(spark, f"{tmp_dir}/csv", SPEC, FlakyTarget(out, 1), LoadOptions(), f"{tmp_dir}/c1", "csv", schema=SCHEMA, fmt="csv",
                   routes_path=f"{tmp_dir}/r1", header=True, sep=";")
    assert len(redrive(spark, f"{tmp_dir}/r1", SCHEMA, SPEC, out, LoadOptions(), "csv", fmt="csv", header=True, sep=";")) == 1
    assert ids(out, spark) == [1, 2]
    put(f"{tmp_dir}/open", "o.json", 5, 6)
    lines = PathTarget(f"{tmp_dir}/lines")
    load_directory(spark, f"{tmp_dir}/open", SPEC, lines, LoadOptions(), f"{tmp_dir}/c2", "open", open_records=True, routes_path=f"{tmp_dir}/r2", lines=True)
    assert ids(lines, spark) == [5, 6] and {r.route for r in read_routes(spark, f"{tmp_dir}/r2").collect()} == {"success"}
