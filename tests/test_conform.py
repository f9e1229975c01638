"""Name translation, alignment, null-fill, unmatched fields and
columns, colliding names, sub-record selection, match report."""

import pytest
from pyspark.sql import functions as F

from record_loader import ConfigError, LoadOptions, TargetSpec
from record_loader.functions.names import normalize_name
from record_loader.operators import (conform, conform_open, match_report, normalize_fields,
                                     select_records, to_open_records)
from record_loader.operators.conform import ERROR, WARNING

PERSONS = TargetSpec.of("PERSONS", [("id", "int", True), ("name", "string"), ("code", "int"),
                                    ("dt", "date")], key=("id",),
                        checks=("code >= 0 AND code < 1000",))


def test_normalize_name_rules(spark):
    assert normalize_name("binaryData") == "BINARYDATA"
    assert normalize_name("binary_data") == "BINARYDATA"
    assert normalize_name("lastTransactionTime") == normalize_name("lasttransactiontime")
    assert normalize_name("o-order-key", "PATTERN", "[-_]") == "OORDERKEY"
    assert normalize_name("Name", "NONE") == "Name"


def test_insert_fixture(spark):
    df = spark.createDataFrame(
        [(1, "rec1", 101, "2021-01-26"), (2, "rec2", 102, "2021-07-26"), (3, "rec3", 103, None),
         (4, "rec4", 104, None), (5, None, 105, None)], "id int, name string, code int, dt string")
    rows = conform(df, PERSONS).orderBy("id").collect()
    assert [(r.id, r.name, r.code, str(r.dt) if r.dt else None) for r in rows] == [
        (1, "rec1", 101, "2021-01-26"), (2, "rec2", 102, "2021-07-26"), (3, "rec3", 103, None),
        (4, "rec4", 104, None), (5, None, 105, None)]
    assert all(r[ERROR] is None for r in rows)


def test_missing_column_is_null(spark):
    df = spark.createDataFrame([(1, "rec1"), (5, None)], "id int, name string")
    rows = conform(df, PERSONS).orderBy("id").collect()
    assert [r.code for r in rows] == [None, None] and all(r[ERROR] is None for r in rows)


def test_extra_field_ignore_and_fail(spark):
    df = spark.createDataFrame([(1, "rec1", "test")], "id int, name string, extra string")
    assert conform(df, PERSONS).first()[ERROR] is None
    err = conform(df, PERSONS, LoadOptions(unmatched_field="fail")).first()[ERROR]
    assert "Cannot map field 'extra'" in err and "IDENTITY" not in err and "ID,NAME,CODE,DT" in err


def test_required_column_modes(spark):
    df = spark.createDataFrame([("rec1", 101)], "name string, code int")
    assert "Required column 'id'" in conform(df, PERSONS).first()[ERROR]
    r = conform(df, PERSONS, LoadOptions(unmatched_column="warn")).first()
    assert r[ERROR] is None and "Required column 'id'" in r[WARNING]
    r = conform(df, PERSONS, LoadOptions(unmatched_column="ignore")).first()
    assert r[ERROR] is None and r[WARNING] is None


def test_reorder_by_name_not_position(spark):
    spec = TargetSpec.of("TEMP", [("id", "int", True), ("code", "int"), ("name", "string")])
    df = spark.createDataFrame([("rec1", 1, 101), ("rec2", 2, 102)], "name string, id int, code int")
    out = conform(df, spec)
    assert out.columns[:3] == ["id", "code", "name"]
    assert sorted((r.id, r.code, r.name) for r in out.collect()) == [(1, 101, "rec1"), (2, 102, "rec2")]


def test_binary_data_name_translation(spark):
    spec = TargetSpec.of("HEX_STRING_TEST", [("id", "int", True), ("binary_data", "binary")])
    df = spark.createDataFrame([(1, "abCDef")], "id int, binaryData string")
    r = conform(df, spec, LoadOptions(binary_format="hex")).first()
    assert bytes(r.binary_data) == bytes([0xAB, 0xCD, 0xEF])


def test_translation_none_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, "x")], "id int, NAME string")
    r = conform(df, PERSONS, LoadOptions(translation="NONE")).first()
    assert r.name is None and r.id == 1


def test_colliding_fields_later_wins_uniform(spark):
    df = spark.createDataFrame([(1, "first", "second")], "id int, na_me string, name string")
    assert normalize_fields(df).columns == ["ID", "NAME"]
    assert conform(df, PERSONS).first().name == "second"


def test_colliding_fields_later_wins_open(spark):
    df = spark.createDataFrame([("u", 0, {"id": "1"})], "source_id string, pos long, fields map<string,string>")
    df = df.select("source_id", "pos", F.map_concat("fields", F.create_map(F.lit("NAME"), F.lit("a")),
                                                    F.create_map(F.lit("name"), F.lit("b"))).alias("fields"))
    r = conform_open(df, PERSONS).first()
    assert r.name == "b" and r.id == 1


def test_open_records_round_trip(spark):
    df = spark.createDataFrame([(1, "rec1", 101)], "id int, name string, code int")
    r = conform_open(to_open_records(df), PERSONS).first()
    assert (r.id, r.name, r.code, r[ERROR]) == (1, "rec1", 101, None)


def test_select_records_struct_and_array(spark):
    df = spark.createDataFrame([("u1", 0, (1, "a"), [(2, "b"), (3, "c")]), ("u2", 0, None, [])],
                               "source_id string, pos long, one struct<id:int,name:string>, "
                               "many array<struct<id:int,name:string>>")
    one = select_records(df, "one").orderBy("source_id").collect()
    assert (one[0].id, one[0].name, one[0][ERROR]) == (1, "a", None) and one[1][ERROR] is not None
    many = select_records(df, "many").collect()
    assert sorted(r.id for r in many if r.id is not None) == [2, 3]
    assert [r.source_id for r in many if r[ERROR] is not None] == ["u2"]
    with pytest.raises(TypeError):
        select_records(df.withColumn("x", F.lit(1)), "x")


def test_match_report(spark):
    df = spark.createDataFrame([("u", 0, {"id": "1", "extra": "x"}), ("u", 1, {"id": "2"})],
                               "source_id string, pos long, fields map<string,string>")
    rep = {(r.field_name, r.column_name): (r.n_records, r.status) for r in match_report(df, PERSONS).collect()}
    assert rep[("ID", "id")] == (2, "matched")
    assert rep[("EXTRA", None)] == (1, "unmatched_field")
    assert rep[(None, "code")] == (0, "unmatched_column")


def test_option_validation():
    with pytest.raises(ConfigError):
        LoadOptions(auto_commit=True, rollback_on_failure=True, max_units=0).validate()
    with pytest.raises(ConfigError):
        LoadOptions(auto_commit=True, max_units=5).validate()
    with pytest.raises(ConfigError):
        LoadOptions(translation="PATTERN").validate()
    # the reference's parameterised matrix (auto_commit, rollback, max batch)
    for ac, rb, mb in [(False, False, 0), (None, True, 1), (False, True, 1000), (True, False, 0)]:
        LoadOptions(auto_commit=ac, rollback_on_failure=rb, max_units=mb).validate()
    assert LoadOptions(timeout_ms=2500).timeout_seconds == 2
    assert LoadOptions(timeout_ms=999).timeout_seconds == 0
