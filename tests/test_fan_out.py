"""K4: one load into many tables, written by one job and committed together."""

import glob

import pytest
from pyspark.sql import functions as F

from record_loader import LoadOptions, TargetSpec
from record_loader.operators.routing import TransientLoadError
from record_loader.plans import load_fan_out
from record_loader.sinks import FanOutTarget

COLUMNS = [("id", "int", True), ("name", "string"), ("code", "int")]
SPEC = TargetSpec.of("persons", COLUMNS, key=("id",), checks=("code >= 0",))
NAMES = ["2024", "2024-01-01", "b/c"]                # read as a number, a date, a folder


def frames(spark, rows, units):
    recs = spark.createDataFrame(rows, "source_id string, pos long, id int, name string, code string")
    return recs, spark.createDataFrame(units, "source_id string, table string")


def tables(target, spark):
    return {n: sorted(r.id for r in target.read(spark, "id int", table=n).collect()) for n in NAMES}


def test_each_table_has_its_rows_and_each_unit_its_route(spark, tmp_dir):
    rows = [("a", 0, 1, "x", "1"), ("a", 1, 2, "x", "1"), ("b", 0, 3, "x", "1"), ("c", 0, 4, "x", "bad"), ("d", 0, 5, "x", "-1"), ("e", 0, 6, "x", "1"),
            ("f", 0, 7, "x", "1"), (None, 0, 8, "x", "1"), ("stray", 0, 9, "x", "1")]
    units = [("a", "2024"), ("b", "2024-01-01"), ("c", "2024"), ("d", "b/c"), ("e", "b/c"), ("f", "none"), ("empty", "2024"), ("a", "2024")]
    target = FanOutTarget(f"{tmp_dir}/out")
    recs, listed = frames(spark, rows, units)
    routes, inserted = load_fan_out(recs, listed, "${table}", NAMES, SPEC, target, token="t1")
    got = {r.source_id: (r.target, r.route, r.rows) for r in routes.collect()}
    assert got == {"a": ("2024", "success", 2), "b": ("2024-01-01", "success", 1), "c": ("2024", "failure", 0), "empty": ("2024", "success", 0),
                   "d": ("b/c", "failure", 0), "e": ("b/c", "failure", 0),           # a broken CHECK rejects its own table only
                   "f": ("none", "failure", 0), None: (None, "failure", 0), "stray": (None, "failure", 0)}
    assert routes.count() == len(got) and all(r.error for r in routes.where("route = 'failure'").collect())
    assert inserted == 3 and tables(target, spark) == {"2024": [1, 2], "2024-01-01": [3], "b/c": []}
    assert sorted((r.load_table, r.id) for r in target.read(spark).collect()) == [("2024", 1), ("2024", 2), ("2024-01-01", 3)]
    _, again = load_fan_out(recs, listed, "${table}", NAMES, SPEC, target, token="t1")       # a replay
    assert again == 3 and tables(target, spark)["2024"] == [1, 2]
    _, more = load_fan_out(*frames(spark, [("z", 0, 10, "x", "1")], [("z", "b/c")]), "${table}", NAMES, SPEC, target, token="t2")
    assert more == 1 and tables(target, spark)["b/c"] == [10]


class Dies(FanOutTarget):
    def commit(self, *args):
        raise TransientLoadError("lost")


def test_rows_that_were_staged_but_not_committed_are_seen_in_no_table(spark, tmp_dir):
    recs, listed = frames(spark, [("a", 0, 1, "x", "1"), ("b", 0, 2, "x", "1")], [("a", "2024"), ("b", "b/c")])
    routes, inserted = load_fan_out(recs, listed, "${table}", NAMES, SPEC, Dies(f"{tmp_dir}/out"), token="t")
    assert {r.route for r in routes.collect()} == {"retry"} and not inserted
    target = FanOutTarget(f"{tmp_dir}/out")
    assert tables(target, spark) == {n: [] for n in NAMES}
    load_fan_out(recs, listed, "${table}", NAMES, SPEC, target, token="t")
    assert tables(target, spark) == {"2024": [1], "2024-01-01": [], "b/c": [2]}
    assert target.recover(spark, 0) == 1 and tables(target, spark)["2024"] == [1]


def test_nothing_to_load(spark, tmp_dir):
    target = FanOutTarget(f"{tmp_dir}/out")
    recs, listed = frames(spark, [("c", 0, 4, "x", "bad")], [("c", "2024")])
    routes, inserted = load_fan_out(recs, listed, "${table}", NAMES, SPEC, target, token="t")
    assert [r.route for r in routes.collect()] == ["failure"] and inserted == 0
    assert load_fan_out(recs, listed, "${table}", NAMES, SPEC, target, token="t")[1] == 0
    recs, listed = frames(spark, [], [])
    assert load_fan_out(recs, listed, "${table}", NAMES, SPEC, target)[0].collect() == []


def test_keys_and_names_that_a_fan_out_does_not_take(spark, tmp_dir):
    recs, listed = frames(spark, [], [])
    for spec in (TargetSpec.of("p", COLUMNS, key=("id",), unique_key=True), TargetSpec.of("p", COLUMNS + [("load_table", "string")])):
        with pytest.raises(ValueError):
            load_fan_out(recs, listed, "${table}", NAMES, spec, FanOutTarget(f"{tmp_dir}/out"))


def test_small_tables_take_few_files_and_records_are_read_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    recs = (spark.range(0, 2000, 1, 8).select(F.concat(F.lit("u"), F.col("id") % 30).alias("source_id"), F.col("id").alias("pos"), F.col("id").cast("int").alias("id"),
                                              F.lit("x").alias("name"), F.lit(1).alias("code")))
    units = recs.select("source_id", F.concat(F.lit("t"), F.substring("source_id", 2, 9).cast("int") % 10).alias("table")).distinct()
    recs = recs.mapInPandas(counted, recs.schema)
    target, names = FanOutTarget(f"{tmp_dir}/out"), [f"t{k}" for k in range(10)]
    routes, inserted = load_fan_out(recs, units, "${table}", names, SPEC, target, LoadOptions(), token="t")
    assert inserted == 2000 and target.read(spark).groupBy("load_table").count().count() == 10
    assert seen.value == 2000                          # converted once for ten tables
    assert len(glob.glob(f"{tmp_dir}/out/data/*/*/*/*.parquet")) <= 20
    assert routes.where("route = 'success'").count() == 30
