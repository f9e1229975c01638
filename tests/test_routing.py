"""F1-F5, B1-B3, A1-A3, W1."""

from pyspark.sql import functions as F

from record_loader.operators import (enforce_constraints, missing_target, plan_batches,
                                     quarantine_units, replacing_merge, resolve_target,
                                     route_units, take_batch)
from record_loader.operators.routing import TransientLoadError, is_transient


def test_quarantine_whole_unit(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, "bad"), ("b", 0, None), ("c", 0, None),
                                ("c", 1, "x"), ("c", 2, "y")], "source_id string, pos long, _error string")
    good, failed = quarantine_units(df)
    assert sorted(r.source_id for r in good.collect()) == ["b"]
    assert sorted((r.source_id, r.error) for r in failed.collect()) == [("a", "bad"), ("c", "x")]


def test_quarantine_unknown_error(spark):
    df = spark.createDataFrame([("a", 0, True)], "source_id string, pos long, bad boolean")
    _, failed = quarantine_units(df, F.col("bad"), F.lit(None).cast("string"))
    assert failed.first().error == "Unknown"


def test_constraint_rejects_whole_batch(spark):
    df = spark.createDataFrame([(0, 1, 101), (0, 2, 102), (0, 3, 1000), (0, 4, 104), (1, 5, 5), (2, 6, 6),
                                (2, 6, 7)], "batch_id long, id int, code int")
    acc, rej = enforce_constraints(df, ["code >= 0 AND code < 1000"], ["id"], ["id"])
    assert sorted(r.id for r in acc.collect()) == [5]
    assert sorted(r.batch_id for r in rej.collect()) == [0, 2]


def test_transient_unwraps_one_level():
    assert is_transient(TransientLoadError("x"))
    try:
        try:
            raise TransientLoadError("inner")
        except TransientLoadError as e:
            raise RuntimeError("wrapper") from e
    except RuntimeError as outer:
        assert is_transient(outer)
    assert not is_transient(RuntimeError("permanent"))


def test_plan_batches_counts_units(spark):
    units = spark.createDataFrame([(f"f{i}", i) for i in range(7)], "source_id string, arrival long")
    got = [r.batch_id for r in plan_batches(units, 3).orderBy("arrival").collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2]
    assert {r.batch_id for r in plan_batches(units, 0).collect()} == {0}
    assert [r.source_id for r in take_batch(units, 3).collect()] == ["f0", "f1", "f2"]


def test_target_resolution(spark):
    units = spark.createDataFrame([("u1", "PERSONS"), ("u2", "PERSONS2"), ("u3", None)],
                                  "source_id string, table string")
    units = resolve_target(units, "${table}")
    known = spark.createDataFrame([("PERSONS",)], "target string")
    miss = {r.source_id: r.error for r in missing_target(units, known).collect()}
    assert set(miss) == {"u2", "u3"} and "PERSONS2" in miss["u2"] and "blank" in miss["u3"]
    blank = resolve_target(units, "${not.a.real.attr}").select("target").distinct().collect()
    assert [r.target for r in blank] == [""]
    routes = {r.source_id: r.route for r in route_units(units, known).collect()}
    assert routes == {"u1": "success", "u2": "failure", "u3": "failure"}


def test_replacing_merge_latest_and_idempotent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "x")], "k int, v int, s string")
    once = replacing_merge(df, "k", "v")
    assert sorted(tuple(r) for r in once.collect()) == [(1, 3, "c"), (2, 1, "x")]
    twice = replacing_merge(once, "k", "v")
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_plan_batches_per_target_distributed(spark):
    rows = [(f"a{i:03d}", i, "T1") for i in range(25)] + [(f"b{i:03d}", 100 + i, "T2") for i in range(7)]
    units = spark.createDataFrame(rows, "source_id string, arrival long, target string")
    got = {r.source_id: r.batch_id for r in plan_batches(units, 4, num_partitions=5).collect()}
    assert [got[f"a{i:03d}"] for i in range(25)] == [i // 4 for i in range(25)]
    assert [got[f"b{i:03d}"] for i in range(7)] == [i // 4 for i in range(7)]


def test_plan_batches_keeps_units_without_a_target(spark):
    rows = [(f"a{i}", i, None if i % 2 else "T1", None if i % 3 else "x") for i in range(20)]
    units = spark.createDataFrame(rows, "source_id string, arrival long, target string, part string")
    got = {r.source_id: r.batch_id for r in plan_batches(units, 4, num_partitions=3).collect()}
    assert got == {f"a{i}": i // 2 // 4 for i in range(20)}
    both = plan_batches(units, 2, partition_cols=("target", "part"), num_partitions=3)
    assert both.columns == [*units.columns, "batch_id"] and both.count() == 20


def test_route_batches_by_outcome(spark):
    from record_loader.operators import route_batches
    units = spark.createDataFrame([("u1",), ("u2",)], "source_id string")
    assert {r.route for r in route_batches(units, None).collect()} == {"success"}
    r = route_batches(units, TransientLoadError("deadlock")).first()
    assert r.route == "retry" and "deadlock" in r.error
    assert route_batches(units, ValueError("bad")).first().route == "failure"
