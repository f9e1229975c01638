"""Record files, malformed units, file streams."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from record_loader import LoadOptions, TargetSpec
from record_loader.operators import conform, conform_open, quarantine_units
from record_loader.plans import load_batch
from record_loader.sinks import PathTarget, read_routes
from record_loader.sources import read_open_records, read_records
from record_loader.streaming import read_record_stream, redrive, stream_load, unit_states
from record_loader.streaming.recipes import FlakyTarget

# Columns, records and names of the fixtures below must match.
PERSON = TargetSpec.of("person", [("id", "int", True), ("name", "string", True), ("age", "int"),
                                  ("favorite_color", "string"), ("dob", "date"),
                                  ("lasttransactiontime", "timestamp"), ("remarks", "string")])
SCHEMA = "id int, name string, code int"
SPEC = TargetSpec.of("PERSONS", [("id", "int", True), ("name", "string"), ("code", "int")], key=("id",))


def write(dirpath, name, text):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as f:
        f.write(text)


def test_single_object_units_open_records(spark, tmp_dir):
    write(tmp_dir, "a.json", json.dumps({"id": 1, "name": "John Doe", "age": 50, "favorite_color": "blue"}))
    write(tmp_dir, "b.json", json.dumps({"id": 2, "name": "John Doe", "age": 50, "dob": "1975-01-01"}))
    write(tmp_dir, "c.json", json.dumps({"id": 3, "name": "Jane", "lastTransactionTime": "1707238288351",
                                         "remarks": {"text": "New York", "lastEditedAt": "NY"}}))
    recs = read_open_records(spark, tmp_dir)
    rows = {r.id: r for r in conform_open(recs, PERSON).collect()}
    assert rows[1].favorite_color == "blue" and str(rows[2].dob) == "1975-01-01"
    assert rows[3].remarks == '{"text":"New York","lastEditedAt":"NY"}'
    assert rows[3].lasttransactiontime is not None and all(r._error is None for r in rows.values())


def test_malformed_file_fails_only_its_unit(spark, tmp_dir):
    write(tmp_dir, "good.json", '{"id": 1, "name": "rec1", "code": 101}\n{"id": 2, "name": "rec2", "code": 102}\n')
    write(tmp_dir, "bad.json", '{"id": 3, "name": "rec3", "code": 103}\n{"id": 4, "name": \n')
    recs = read_records(spark, tmp_dir, "json", SCHEMA)
    good, failed = quarantine_units(conform(recs, SPEC))
    assert sorted(r.id for r in good.collect()) == [1, 2]
    assert [r.source_id.endswith("bad.json") for r in failed.collect()] == [True]


def test_csv_and_parquet_sources(spark, tmp_dir):
    write(tmp_dir + "/csv", "a.csv", "id,name,code\n1,rec1,101\n2,rec2,oops\n")
    recs = read_records(spark, tmp_dir + "/csv", "csv", "id int, name string, code int", header="true")
    target = PathTarget(os.path.join(tmp_dir, "csv-out"))
    res = load_batch(recs, SPEC, target)
    assert res.failed.count() == 1 and res.loaded.count() == 0
    spark.createDataFrame([(1, "rec1", 101)], SCHEMA).write.parquet(tmp_dir + "/pq")
    recs = read_records(spark, tmp_dir + "/pq", "parquet")
    assert [tuple(r) for r in conform(recs, SPEC).select("id", "name", "code").collect()] == [(1, "rec1", 101)]


def _files(tmp_dir, n=7, bad=()):
    src = os.path.join(tmp_dir, "in")
    for i in range(n):
        code = '"x"' if i in bad else str(100 + i)
        write(src, f"f{i:02d}.json", f'{{"id": {i}, "name": "rec{i}", "code": {code}}}\n')
    return src


def test_stream_micro_batches_of_max_units(spark, tmp_dir):
    src = _files(tmp_dir)
    target = PathTarget(os.path.join(tmp_dir, "out"))
    receipts = os.path.join(tmp_dir, "receipts")
    q = stream_load(read_record_stream(spark, src, SCHEMA, max_units=3), SPEC, target, LoadOptions(),
                    os.path.join(tmp_dir, "ckpt"), "t", receipts_path=receipts)
    q.awaitTermination()
    sizes = [r[1] for r in spark.read.parquet(receipts).groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [3, 3, 1]
    assert sorted(r.id for r in target.read(spark).collect()) == list(range(7))


def test_stream_route_quarantines_bad_files(spark, tmp_dir):
    src = _files(tmp_dir, bad=(2, 5))
    target = PathTarget(os.path.join(tmp_dir, "out"))
    routes = os.path.join(tmp_dir, "routes")
    stream_load(read_record_stream(spark, src, SCHEMA, max_units=3), SPEC, target, LoadOptions(),
                os.path.join(tmp_dir, "ckpt"), "t", routes_path=routes).awaitTermination()
    assert sorted(r.id for r in target.read(spark).collect()) == [0, 1, 3, 4, 6]
    failed = read_routes(spark, routes, "failure").collect()
    assert sorted(os.path.basename(r.source_id) for r in failed) == ["f02.json", "f05.json"]


def test_stream_rollback_replays_without_duplicates(spark, tmp_dir):
    src = _files(tmp_dir)
    inner = PathTarget(os.path.join(tmp_dir, "out"))
    target = FlakyTarget(inner, failures=1)
    ckpt, receipts = os.path.join(tmp_dir, "ckpt"), os.path.join(tmp_dir, "receipts")
    run = lambda: stream_load(read_record_stream(spark, src, SCHEMA, max_units=3), SPEC, target,
                              LoadOptions(), ckpt, "t", receipts_path=receipts,
                              on_failure="rollback").awaitTermination()
    try:
        run()
        raised = False
    except StreamingQueryException:
        raised = True
    assert raised
    run()
    assert sorted(r.id for r in inner.read(spark).collect()) == list(range(7))


def test_redrive_retry_units(spark, tmp_dir):
    src = _files(tmp_dir)
    inner = PathTarget(os.path.join(tmp_dir, "out"))
    routes = os.path.join(tmp_dir, "routes")
    stream_load(read_record_stream(spark, src, SCHEMA, max_units=3), SPEC, FlakyTarget(inner, 10**6),
                LoadOptions(), os.path.join(tmp_dir, "ckpt"), "t", routes_path=routes).awaitTermination()
    assert read_routes(spark, routes, "retry").count() == 7
    for _ in range(2):                     # the second call finds every unit loaded
        redrive(spark, routes, SCHEMA, SPEC, inner, LoadOptions(max_units=3), "t2")
        assert sorted(r.id for r in inner.read(spark).collect()) == list(range(7))
    assert read_routes(spark, routes, "success").count() == 7 and read_routes(spark, routes, "failure").count() == 0


def test_redrive_counts_attempts_of_each_unit(spark, tmp_dir):
    src = _files(tmp_dir, n=3)
    target = FlakyTarget(PathTarget(os.path.join(tmp_dir, "out")), 10**6)
    routes = os.path.join(tmp_dir, "routes")
    stream_load(read_record_stream(spark, src, SCHEMA), SPEC, target, LoadOptions(),
                os.path.join(tmp_dir, "ckpt"), "t", routes_path=routes).awaitTermination()
    assert len(redrive(spark, routes, SCHEMA, SPEC, target, LoadOptions(max_units=2), "t", max_attempts=2)) == 2
    assert redrive(spark, routes, SCHEMA, SPEC, target, LoadOptions(), "t", max_attempts=2) == []
    last = {r.source_id: (r.route, r.attempt) for r in unit_states(read_routes(spark, routes)).collect()}
    assert len(last) == 3 and set(last.values()) == {("failure", 3)}


def test_batch_load_of_files_one_insert(spark, tmp_dir):
    """11 records in one unit is one batch and one insert job."""
    write(tmp_dir + "/in", "one.json", "".join(
        f'{{"id": {i}, "name": "rec{i}", "code": {100 + i}}}\n' for i in range(1, 12)))
    target = PathTarget(os.path.join(tmp_dir, "out"))
    res = load_batch(read_records(spark, tmp_dir + "/in", "json", SCHEMA), SPEC, target,
                     LoadOptions(max_units=5))
    assert [tuple(r) for r in res.units.select("route", "rows").collect()] == [("success", 11)]
    assert target.read(spark).count() == 11


def test_load_directory_batches_by_units(spark, tmp_dir):
    from record_loader.streaming import load_directory, read_receipts
    src = _files(tmp_dir, n=5)
    target = PathTarget(os.path.join(tmp_dir, "out"))
    receipts = os.path.join(tmp_dir, "receipts")
    load_directory(spark, src, SPEC, target, LoadOptions(max_units=2), os.path.join(tmp_dir, "ckpt"),
                   "dir", schema=SCHEMA, receipts_path=receipts)
    sizes = [r[1] for r in read_receipts(spark, receipts).groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [2, 2, 1]
    # a rerun with the same checkpoint loads nothing twice
    load_directory(spark, src, SPEC, target, LoadOptions(max_units=2), os.path.join(tmp_dir, "ckpt"),
                   "dir", schema=SCHEMA, receipts_path=receipts)
    assert sorted(r.id for r in target.read(spark).collect()) == list(range(5))


def test_one_load_per_target(spark, tmp_dir):
    from record_loader.plans import load_per_target
    recs = spark.createDataFrame([("a", 0, 1, "x", 1), ("b", 0, 2, "y", 2), ("c", 0, 3, "z", 3),
                                  ("d", 0, 4, "w", 4)], "source_id string, pos long, id int, name string, code int")
    units = spark.createDataFrame([("a", "T1"), ("b", "T2"), ("c", "T9"), ("d", None)],
                                  "source_id string, table string")
    t1, t2 = PathTarget(os.path.join(tmp_dir, "t1")), PathTarget(os.path.join(tmp_dir, "t2"))
    results, missing = load_per_target(recs, units, "${table}", {"T1": (SPEC, t1), "T2": (SPEC, t2)})
    assert [r.id for r in t1.read(spark).collect()] == [1]
    assert [r.id for r in t2.read(spark).collect()] == [2]
    miss = {r.source_id: r.error for r in missing.collect()}
    assert set(miss) == {"c", "d"} and "T9" in miss["c"]


def test_catalog_table_target(spark, tmp_dir):
    from record_loader.sinks import TableTarget
    spark.sql(f"CREATE TABLE IF NOT EXISTS persons_tbl (id INT, name STRING, code INT) USING parquet "
              f"LOCATION '{tmp_dir}/tbl'")
    try:
        recs = spark.createDataFrame([("u", 0, 1, "rec1", 101)], "source_id string, pos long, id int, name string, code int")
        res = load_batch(recs, TargetSpec.from_table(spark, "persons_tbl"), TableTarget("persons_tbl"))
        assert res.outcome is None
        assert [tuple(r) for r in spark.table("persons_tbl").collect()] == [(1, "rec1", 101)]
    finally:
        spark.sql("DROP TABLE IF EXISTS persons_tbl")


def test_replayed_micro_batch_is_not_appended_twice(spark, tmp_dir):
    """A crash after the insert but before the receipt replays the batch;
    an idempotent path target rewrites the batch's folder instead."""
    from record_loader.streaming import batch_loader
    recs = spark.createDataFrame([("f1", 1, "rec1", 101), ("f2", 2, "rec2", 102)],
                                 "source_id string, id int, name string, code int")
    target = PathTarget(os.path.join(tmp_dir, "out"), idempotent=True)
    run = batch_loader(SPEC, target, LoadOptions(), "t")
    run(recs, 7)
    run(recs, 7)                       # replay of the same micro-batch
    run(recs.where(F.col("id") == 1), 8)
    assert sorted(r.id for r in target.read(spark).collect()) == [1, 1, 2]
    assert target.read(spark).columns == ["id", "name", "code"]


def test_open_record_stream_of_single_objects(spark, tmp_dir):
    """One JSON object per file, fields differing between files (timestamps
    as epoch ms text, formatted text, decimal seconds; a nested record)."""
    src = os.path.join(tmp_dir, "in")
    objs = [{"id": 1, "name": "John Doe", "age": 50, "favorite_color": "blue"},
            {"id": 2, "name": "John Doe", "age": 50, "dob": "1975-01-01"},
            {"id": 3, "name": "A", "lastTransactionTime": "1707238288351"},
            {"id": 4, "name": "B", "lastTransactionTime": "2024-02-06 11:51:28.351567"},
            {"id": 5, "name": "C", "lastTransactionTime": "1.707238288351567E9",
             "remarks": {"text": "New York", "lastEditedAt": "NY"}},
            {"id": 6, "name": "D", "age": "not a number"}]
    for i, o in enumerate(objs):
        write(src, f"p{i}.json", json.dumps(o))
    target = PathTarget(os.path.join(tmp_dir, "out"))
    routes = os.path.join(tmp_dir, "routes")
    stream_load(read_record_stream(spark, src, open_records=True, max_units=4), PERSON, target,
                LoadOptions(), os.path.join(tmp_dir, "ckpt"), "people", routes_path=routes,
                open_records=True).awaitTermination()
    rows = {r.id: r for r in target.read(spark).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[1].favorite_color == "blue" and str(rows[2].dob) == "1975-01-01"
    assert str(rows[3].lasttransactiontime) == "2024-02-06 16:51:28.351000"
    assert str(rows[4].lasttransactiontime) == "2024-02-06 11:51:28.351567"
    assert str(rows[5].lasttransactiontime) == "2024-02-06 16:51:28.351567"
    assert rows[5].remarks == '{"text":"New York","lastEditedAt":"NY"}'
    failed = read_routes(spark, routes, "failure").collect()
    assert [os.path.basename(r.source_id) for r in failed] == ["p5.json"]


def test_multiline_json_and_orc_sources(spark, tmp_dir):
    write(tmp_dir + "/ml", "a.json", '[\n {"id": 1, "name": "rec1", "code": 101},\n {"id": 2, "name": "rec2", "code": 102}\n]')
    recs = read_records(spark, tmp_dir + "/ml", "json", SCHEMA, multi_line=True)
    target = PathTarget(os.path.join(tmp_dir, "ml-out"))
    assert load_batch(recs, SPEC, target).n_units == 1
    assert sorted(r.id for r in target.read(spark).collect()) == [1, 2]
    spark.createDataFrame([(3, "rec3", 103)], SCHEMA).write.orc(tmp_dir + "/orc")
    recs = read_records(spark, tmp_dir + "/orc", "orc")
    assert [r.id for r in conform(recs, SPEC).collect()] == [3]
