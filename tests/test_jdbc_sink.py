"""K1/K2 on embedded Derby (in-process, no port): single, staged and parallel
inserts, batch rejection, rollback, unknown target, LOB columns."""

import pytest
from pyspark.sql import functions as F

from record_loader import LoadOptions, TargetSpec
from record_loader.plans import BatchRolledBack, load_batch
from record_loader.sinks import JdbcTarget
from record_loader.sinks.targets import jvm_sql_runner
from record_loader.streaming.recipes import FlakyTarget

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
PERSONS_DDL = ("CREATE TABLE PERSONS (id integer NOT NULL PRIMARY KEY, name varchar(100), code integer, "
               "dt date, CONSTRAINT CODE_RANGE CHECK (code >= 0 AND code < 1000))")
PERSONS = TargetSpec.of("PERSONS", [("ID", "int", True), ("NAME", "string"), ("CODE", "int"), ("DT", "date")],
                        key=("ID",))
PERSONS_CHECKED = TargetSpec.of("PERSONS", PERSONS.columns, key=("ID",),
                                checks=("CODE >= 0 AND CODE < 1000",))


@pytest.fixture
def db(spark, tmp_dir):
    url = f"jdbc:derby:{tmp_dir}/db;create=true"
    spark.sparkContext._jvm.java.lang.Class.forName(DRIVER["driver"])
    run = jvm_sql_runner(spark, url, {})
    run([PERSONS_DDL])
    return url, run


def records(spark, rows, ddl="id int, name string, code int", unit="unit-1"):
    df = spark.createDataFrame(rows, ddl)
    return df.select(F.lit(unit).alias("source_id"), F.monotonically_increasing_id().alias("pos"), *df.columns)


def persons(spark, url):
    return sorted(tuple(r) for r in JdbcTarget(url, "PERSONS", DRIVER).read(spark).select("ID", "NAME", "CODE").collect())


@pytest.mark.parametrize("mode", ["single", "staged", "parallel"])
def test_insert_modes(spark, db, mode):
    url, run = db
    target = JdbcTarget(url, "PERSONS", DRIVER, execute_sql=run)
    recs = records(spark, [(i, f"rec{i}", 100 + i) for i in range(1, 12)]).repartition(4)
    res = load_batch(recs, PERSONS, target, LoadOptions(mode=mode))
    assert res.outcome is None and res.rows_inserted == 11
    assert persons(spark, url) == [(i, f"rec{i}", 100 + i) for i in range(1, 12)]
    assert [tuple(r) for r in res.units.select("route", "rows").collect()] == [("success", 11)]


def test_batch_rejected_by_checks_leaves_table_empty(spark, db):
    url, run = db
    target = JdbcTarget(url, "PERSONS", DRIVER, execute_sql=run)
    recs = records(spark, [(1, "rec1", 101), (2, "rec2", 102), (3, "rec3", 1000), (4, "rec4", 104)])
    res = load_batch(recs, PERSONS_CHECKED, target)
    assert persons(spark, url) == []
    assert [r.route for r in res.units.collect()] == ["failure"]
    with pytest.raises(BatchRolledBack):
        load_batch(recs, PERSONS_CHECKED, target, LoadOptions(rollback_on_failure=True))
    assert persons(spark, url) == []


@pytest.mark.parametrize("mode", ["single", "staged"])
def test_database_constraint_keeps_atomicity(spark, db, mode):
    """Without the pre-check the database rejects the row; single and staged
    inserts leave the table unchanged."""
    url, run = db
    target = JdbcTarget(url, "PERSONS", DRIVER, execute_sql=run)
    recs = records(spark, [(i, f"rec{i}", 1000 if i == 7 else i) for i in range(1, 41)]).repartition(4)
    res = load_batch(recs, PERSONS, target, LoadOptions(mode=mode))
    assert res.outcome is not None
    assert persons(spark, url) == []
    assert {r.route for r in res.units.collect()} == {"failure"}


def test_unknown_target_fails_with_name(spark, db):
    url, run = db
    res = load_batch(records(spark, [(1, "rec1", 101)]), PERSONS, JdbcTarget(url, "PERSONS2", DRIVER))
    r = res.units.first()
    assert r.route == "failure" and "PERSONS2" in r.error


def test_transient_failure_routes_to_retry(spark, db):
    url, run = db
    target = FlakyTarget(JdbcTarget(url, "PERSONS", DRIVER), failures=1)
    res = load_batch(records(spark, [(1, "rec1", 101)]), PERSONS, target)
    assert res.units.first().route == "retry"
    res = load_batch(records(spark, [(1, "rec1", 101)]), PERSONS, target)
    assert res.units.first().route == "success" and persons(spark, url) == [(1, "rec1", 101)]


def test_one_bad_unit_does_not_sink_the_batch(spark, db):
    url, run = db
    ddl = "id string, name string, code string"
    good = records(spark, [("1", "rec1", "101"), ("2", "rec2", "102")], ddl, unit="good")
    bad = records(spark, [("3", "rec3", "x")], ddl, unit="bad")
    res = load_batch(good.unionByName(bad), PERSONS, JdbcTarget(url, "PERSONS", DRIVER))
    assert persons(spark, url) == [(1, "rec1", 101), (2, "rec2", 102)]
    routes = {r.source_id: (r.route, r.rows) for r in res.units.collect()}
    assert routes == {"good": ("success", 2), "bad": ("failure", 0)}


def test_lob_columns(spark, tmp_dir):
    url = f"jdbc:derby:{tmp_dir}/lob;create=true"
    run = jvm_sql_runner(spark, url, {})
    run(["CREATE TABLE PERSONS_LOB (id integer NOT NULL PRIMARY KEY, name clob, content blob, code integer)"])
    spec = TargetSpec.of("PERSONS_LOB", [("ID", "int", True), ("NAME", "string"), ("CONTENT", "binary"),
                                         ("CODE", "int")])
    target = JdbcTarget(url, "PERSONS_LOB", DRIVER)
    recs = records(spark, [(1, "rec1", 101, [66, 76, 79, 66])], "id int, name string, code int, content array<tinyint>")
    load_batch(recs, spec, target)
    recs = records(spark, [(2, "rec2", 102, "BLOB")], "id int, name string, code int, content string", unit="u2")
    load_batch(recs, spec, target)
    got = sorted((r.ID, r.NAME, bytes(r.CONTENT)) for r in target.read(spark).collect())
    assert got == [(1, "rec1", b"BLOB"), (2, "rec2", b"BLOB")]
    recs = records(spark, [(3, "rec3", 103, [1, 2, 3])], "id int, name string, code int, content array<int>", unit="u3")
    res = load_batch(recs, spec, target)
    assert res.units.first().route == "failure"


def test_spec_from_jdbc(spark, db):
    url, _ = db
    spec = TargetSpec.from_jdbc(spark, url, "PERSONS", DRIVER, required=["ID"], key=["ID"],
                                checks=["CODE >= 0 AND CODE < 1000"])
    assert spec.names == ["ID", "NAME", "CODE", "DT"]
    assert spec.required == ["ID"]
    assert [c.dtype.simpleString() for c in spec.columns] == ["int", "string", "int", "date"]


def test_batch_receipts(spark, db):
    url, run = db
    ddl = "id string, name string, code string"
    recs = records(spark, [("1", "rec1", "101")], ddl, unit="good").unionByName(
        records(spark, [("2", "rec2", "x")], ddl, unit="bad"))
    res = load_batch(recs, PERSONS, JdbcTarget(url, "PERSONS", DRIVER))
    got = {r.source_id: (r.route, r.rows, r.destination, r.attempt)
           for r in res.receipts("persons-load", url).collect()}
    assert got == {"good": ("success", 1, url, 1), "bad": ("failure", 0, url, 1)}
    assert res.rows_inserted == 1
