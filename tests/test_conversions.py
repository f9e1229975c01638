"""T1-T17 with the reference's literal inputs."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from record_loader import LoadOptions, TargetSpec
from record_loader.functions import coerce as C
from record_loader.operators.conform import ERROR, conform


# The literals below are the inputs and results that conversions must match.


def one(spark, value, ddl):
    return spark.createDataFrame([(value,)], ddl)


def conv(spark, value, ddl, fn):
    df = one(spark, value, ddl)
    v, e = fn(F.col(df.columns[0]))
    return df.select(v.alias("v"), e.alias("e")).first()


def test_hex_either_case(spark):
    r = conv(spark, "abCDef", "s string", C.binary_hex)
    assert bytes(r.v) == bytes([0xAB, 0xCD, 0xEF]) and r.e is None


def test_hex_odd_length_is_malformed(spark):
    r = conv(spark, "abc", "s string", C.binary_hex)
    assert r.v is None and r.e is not None


def test_base64(spark):
    r = conv(spark, "Cmfq", "s string", C.binary_base64)
    assert bytes(r.v) == bytes([0x0A, 0x67, 0xEA])


def test_base64_malformed_fails(spark):
    r = conv(spark, "!!", "s string", C.binary_base64)
    assert r.v is None and r.e is not None


def test_utf8_text_to_blob(spark):
    r = conv(spark, "BLOB", "s string", C.binary_utf8)
    assert bytes(r.v) == b"BLOB"


def test_byte_array_to_binary(spark):
    df = spark.createDataFrame([(1, [97, 98, 99]), (2, [100, 101, 102]), (3, [-1, 0]), (4, [])],
                               "id int, b array<tinyint>")
    v, e = C.binary_from_bytes(F.col("b"))
    got = {r.id: (bytes(r.v), r.e) for r in df.select("id", v.alias("v"), e.alias("e")).collect()}
    assert got == {1: (b"abc", None), 2: (b"def", None), 3: (b"\xff\x00", None), 4: (b"", None)}


def test_int_array_to_binary_rejected(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],)], "a array<int>")
    v, e = C.binary_reject(F.col("a"), T.ArrayType(T.IntegerType()))
    rows = df.select(v.alias("v"), e.alias("e")).collect()
    assert rows[0].v is None and rows[0].e is not None
    assert bytes(rows[1].v) == b"" and rows[1].e is None


def test_flexible_timestamp_four_encodings(spark):
    # epoch ms, formatted local time, epoch µs, decimal seconds (Double.toString)
    vals = ["1707238288351", "2024-02-06 11:51:28.351567", "1707238288351567", "1.707238288351567E9"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    v, e = C.flexible_timestamp(F.col("s"), "yyyy-MM-dd HH:mm:ss.SSSSSS", T.TimestampNTZType())
    got = [r.v for r in df.select(v.alias("v")).collect()]
    assert got == [dt.datetime(2024, 2, 6, 16, 51, 28, 351000),
                   dt.datetime(2024, 2, 6, 11, 51, 28, 351567),
                   dt.datetime(2024, 2, 6, 16, 51, 28, 351567),
                   dt.datetime(2024, 2, 6, 16, 51, 28, 351567)]


def test_flexible_timestamp_garbage(spark):
    r = conv(spark, "not a time", "s string", lambda c: C.flexible_timestamp(c))
    assert r.v is None and r.e is not None


def test_date_from_string_and_epoch_ms(spark):
    r = conv(spark, "1975-01-01", "s string", C.date_from_string)
    assert r.v == dt.date(1975, 1, 1)
    # 2021-01-26 local midnight (UTC session) in epoch milliseconds
    r = conv(spark, 1611619200000, "n bigint", C.date_from_epoch_ms)
    assert r.v == dt.date(2021, 1, 26)


def test_enum(spark):
    df = spark.createDataFrame([("diamonds",), ("hearts",), ("stars",)], "s string")
    v, e = C.enum_check(F.col("s"), ["clubs", "diamonds", "hearts", "spades"], "suit")
    rows = df.select(v.alias("v"), e.alias("e")).collect()
    assert [r.v for r in rows] == ["diamonds", "hearts", None]
    assert rows[2].e.startswith("Value for column 'suit'")


def test_uuid(spark):
    r = conv(spark, "425085a0-03ef-11ee-be56-0242ac120002", "s string", C.uuid_to_string)
    assert r.v == "425085a0-03ef-11ee-be56-0242ac120002" and r.e is None
    r = conv(spark, "not-a-uuid", "s string", C.uuid_to_string)
    assert r.v is None and r.e is not None


def test_numeric_text(spark):
    df = spark.createDataFrame([("1",), (" 42 ",), ("12.7",), ("x",), (None,)], "s string")
    v, e = C.number_from_string(F.col("s"), T.IntegerType(), "bad")
    rows = df.select(v.alias("v"), e.alias("e")).collect()
    assert [r.v for r in rows] == [1, 42, None, None, None]
    assert [r.e for r in rows] == [None, None, "bad", "bad", None]


def test_record_to_json_text(spark):
    df = spark.createDataFrame([(("New York", "NY"),)], "r struct<text:string,lastEditedAt:string>")
    v, _ = C.record_to_json(F.col("r"))
    assert df.select(v).first()[0] == '{"text":"New York","lastEditedAt":"NY"}'


def test_null_to_default(spark):
    df = spark.createDataFrame([(None,), (5,)], "q int")
    assert [r[0] for r in df.select(C.null_to_default(F.col("q"), T.IntegerType())).collect()] == [0, 5]


def test_compatible_mismatch_epoch_ms_into_date(spark):
    """dt arrives as BIGINT epoch milliseconds of local midnight."""
    spec = TargetSpec.of("PERSONS", [("id", "int", True), ("name", "string"), ("code", "int"), ("dt", "date")])
    df = spark.createDataFrame([(1, "rec1", 101, 1611619200000), (2, "rec2", 102, 1627257600000),
                                (3, "rec3", 103, None)], "id int, name string, code int, dt bigint")
    got = conform(df, spec).orderBy("id").collect()
    assert [r.dt for r in got] == [dt.date(2021, 1, 26), dt.date(2021, 7, 26), None]
    assert all(r[ERROR] is None for r in got)


def test_incompatible_array_into_scalar(spark):
    spec = TargetSpec.of("PERSONS", [("id", "int", True), ("name", "string"), ("code", "int"), ("dt", "date")])
    df = spark.createDataFrame([("1", "rec1", 101, [1.0, 2.0]), ("3", "rec3", 103, None)],
                               "id string, name string, code int, dt array<float>")
    got = conform(df, spec).collect()
    assert got[0][ERROR] is not None and got[1][ERROR] is None


def test_binary_of_text_opt_in(spark):
    spec = TargetSpec.of("B", [("id", "int"), ("b", "binary")])
    df = spark.createDataFrame([(1, 123)], "id int, b bigint")
    assert conform(df, spec).first()[ERROR] is not None          # default: rejected
    r = conform(df, spec, LoadOptions(binary_from="text")).first()
    assert bytes(r.b) == b"123" and r[ERROR] is None


def test_registered_conversion(spark):
    C.register_conversion("string", "int", lambda c: F.when(c == "one", F.lit(1)).otherwise(c.try_cast("int")))
    try:
        spec = TargetSpec.of("t", [("n", "int")])
        df = spark.createDataFrame([("one",), ("2",), ("x",)], "n string")
        rows = conform(df, spec).collect()
        assert [r.n for r in rows] == [1, 2, None]
        assert [r[ERROR] is None for r in rows] == [True, True, False]
    finally:
        C.unregister_conversion("string", "int")
