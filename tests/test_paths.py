"""Record paths (P10) and open records with types."""

import json

import pytest
from pyspark.sql import functions as F

from record_loader.functions.coerce import binary_from_bytes
from record_loader.operators.conform import ERROR, conform_open
from record_loader.operators.paths import Filter, Step, parse_path
from record_loader.operators.records import select_records
from record_loader.plans.load import load_batch
from record_loader.sinks.targets import PathTarget
from record_loader.sources.files import parse_open_records
from record_loader.spec import LoadOptions, TargetSpec

NESTED = "source_id string, pos long, shop struct<name:string,orders:array<struct<id:bigint,kind:string,lines:array<struct<n:int,q:double>>>>>"
ROWS = [("u", 0, ("s", [(1, "a", [(1, 5.0), (2, 20.0)]), (2, "b", [(3, 30.0)]), (3, "a", None)])),
        ("u", 1, ("s", [(4, "a", [(4, 40.0), None, (5, 1.0)])])),
        ("v", 0, ("s", [])), ("w", 0, None)]
SPEC = TargetSpec.of("lines", [("n", "int"), ("q", "double")])


def outer_json(rows=ROWS):
    def order(o):
        return {"id": o[0], "kind": o[1], "lines": None if o[2] is None else [x and {"n": x[0], "q": x[1]} for x in o[2]]}
    return [(u, p, json.dumps({"shop": shop and {"name": shop[0], "orders": [order(o) for o in shop[1]]}})) for u, p, shop in rows]


def both(spark, path, rows=ROWS):
    """(unit, place, n, error) of the hits, from typed and from open records."""
    typed = select_records(spark.createDataFrame(rows, NESTED), path)
    if "n" not in typed.columns:                       # no type has a record there
        typed = typed.selectExpr("*", "cast(NULL AS int) AS n")
    texts = spark.createDataFrame(outer_json(rows), "source_id string, outer long, t string")
    opened = parse_open_records(texts, "t", keep=["outer"], typed=True).drop("pos").withColumnRenamed("outer", "pos")
    opened = select_records(opened, path)
    opened = opened.selectExpr("source_id", "pos", "try_variant_get(fields['n'], '$', 'int') AS n", ERROR)
    return [sorted(tuple(r) for r in d.selectExpr("source_id", "cast(pos AS decimal(31,0)) AS pos", "n", ERROR).collect())
            for d in (typed, opened)]


def test_steps():
    assert parse_path("a.b") == parse_path("/a/b") == [Step("a"), Step("b")]
    assert parse_path("/'a/b'[0, -1]/*[1..2]") == [Step("a/b", False, (Filter("at", (0, -1)),)), Step("*", True, (Filter("range", (1, 2)),))]
    assert parse_path("/a[./b/c >= 3][*]")[0].filters == (Filter("where", (("b", "c"), ">=", 3)),)
    assert parse_path("/a[./b = ']x']")[0].filters == (Filter("where", (("b",), "=", "]x")),)
    for bad in ("", "/", "/a[", "/a[x]", "/a[./b ~ 1]", "/a//b", "/a[./b = x]"):
        with pytest.raises(ValueError):
            parse_path(bad)


@pytest.mark.parametrize("path, hits", [
    ("/shop/orders/lines", {"u": [1, 2, 3, 4, 5]}),
    ("/shop/orders[*]/lines[*]", {"u": [1, 2, 3, 4, 5]}),
    ("/shop/orders[./kind = 'a']/lines[./q > 10]", {"u": [2, 4]}),
    ("/shop/orders[./kind != 'a']/lines", {"u": [3]}),
    ("/shop/orders/lines[0]", {"u": [1, 3, 4]}),
    ("/shop/orders/lines[-1]", {"u": [2, 3, 5]}),
    ("/shop/orders[1..2]/lines", {"u": [3]}),
    ("/shop/orders[./id <= 1][./kind = 'a']/lines[0, 1]", {"u": [1, 2]}),
    ("/*/orders/lines[./q = 30.0]", {"u": [3]}),
    ("/shop/orders/lines[./missing = 1]", {}),
    ("/shop/none/lines", {}),
    ("/none", {}),
])
def test_hits(spark, path, hits):
    typed, opened = both(spark, path)
    for got in (typed, opened):
        n = {}
        for unit, _, value, error in got:
            if error is None:
                n.setdefault(unit, []).append(value)
        assert n == hits
        assert all(e is None or "No record at path" in e for *_, e in got)
        assert {u for u, *_ in got} == {"u", "v", "w"}          # a unit without hits keeps a row
        assert len({(u, p) for u, p, *_ in got}) == len(got)
    assert typed == opened


def test_positions_in_order(spark):
    got = both(spark, "/shop/orders/lines")[0]
    assert [int(p) for u, p, *_ in got if u == "u"] == [0, 1, 2, (1 << 31), (1 << 31) + 1, (1 << 31) + 2]


def test_null_hit_is_an_error(spark):
    got = both(spark, "/shop/orders/lines")[0]
    assert [(u, n) for u, _, n, e in got if e] == [("u", None), ("v", None), ("w", None)]


def test_wildcard_joins_records_of_different_fields(spark):
    df = spark.createDataFrame([("u", 0, ((1, "x"), [(2, True)], 7))],
                               "source_id string, pos long, r struct<a:struct<id:int,s:string>,b:array<struct<id:int,t:boolean>>,c:int>")
    got = select_records(df.selectExpr("source_id", "pos", "named_struct('a', r.a, 'b', r.b) AS r"), "/r/*").collect()
    assert [(r.id, r.s, r.t, r[ERROR]) for r in got] == [(1, "x", None, None), (2, None, True, None)]
    # a value that is no record is a fault of the whole outer record
    assert {r[ERROR] for r in select_records(df, "/r/*").collect()} == {"Path /r/* holds a value of type int, not a record"}
    clash = spark.createDataFrame([("u", 0, ((1,), ("x",)))], "source_id string, pos long, r struct<a:struct<id:int>,b:struct<id:string>>")
    with pytest.raises(TypeError):
        select_records(clash, "/r/*")


def test_arrays_of_arrays(spark):
    df = spark.createDataFrame([("u", 0, [[(1,), (2,)], None, [], [(3,)]])], "source_id string, pos long, a array<array<struct<id:int>>>")
    assert [r.id for r in select_records(df, "/a").collect()] == [1, 2, 3]
    assert [r.id for r in select_records(df, "/a[-1]").collect()] == [3]


def test_open_records_of_text_have_no_inside(spark):
    texts = spark.createDataFrame([("u", '{"a": {"b": 1}}')], "source_id string, t string")
    with pytest.raises(TypeError):
        select_records(parse_open_records(texts, "t"), "/a")


@pytest.mark.parametrize("snapshot", ["cache", "rescan"])
def test_load_routes_hits_that_are_no_records(spark, tmp_dir, snapshot):
    units = [("good", '{"a": [{"b": {"n": 1, "q": 2}}, {"b": [{"n": "3"}]}]}'), ("none", '{"a": []}'), ("empty", "{}"),
             ("scalar", '{"a": {"b": "text"}}'), ("mixed", '{"a": [{"b": {"n": 1}}, {"b": 5}]}'), ("broken", '{"a": '),
             ("null", '{"a": {"b": null}}')]
    recs = parse_open_records(spark.createDataFrame(units, "source_id string, t string"), "t", typed=True)
    target = PathTarget(f"{tmp_dir}/out")
    result = load_batch(recs, SPEC, target, LoadOptions(record_path="/a/b", snapshot=snapshot), open_records=True)
    none = "No record at path /a/b"
    assert {r.source_id: (r.route, r.rows, r.error) for r in result.units.collect()} == {
        "good": ("success", 2, None), "none": ("failure", 0, none), "empty": ("failure", 0, none), "null": ("failure", 0, none),
        "scalar": ("failure", 0, "Path /a/b holds a value of type STRING, not a record"),
        "mixed": ("failure", 0, "Path /a/b holds a value of type BIGINT, not a record"),
        "broken": ("failure", 0, "Malformed record")}
    assert {(r.n, r.q) for r in target.read(spark).collect()} == {(1, 2.0), (3, None)}


VALUES = [
    # column type, JSON value, expected value, failed
    ("string", '"a"', "a", False), ("string", "12", "12", False), ("string", "true", "true", False),
    ("string", '{"k": 1}', '{"k":1}', False), ("string", "[1, 2]", "[1,2]", False), ("string", "null", None, False),
    ("bigint", "12", 12, False), ("bigint", '"12"', 12, False), ("bigint", '"x"', None, True), ("bigint", "1.9", 1, False),
    ("bigint", "[1]", None, True), ("bigint", '{"k": 1}', None, True), ("tinyint", "300", None, True),
    ("double", "1.5", 1.5, False), ("double", '"1e3"', 1000.0, False), ("double", "1e3", 1000.0, False),
    ("boolean", "true", True, False), ("boolean", '"false"', False, False), ("boolean", "[true]", None, True),
    ("binary", '"hi"', b"hi", False), ("binary", "[104, 105, -1]", b"hi\xff", False), ("binary", "[]", b"", False),
    ("binary", "[104, 300]", None, True), ("binary", '["104"]', None, True), ("binary", "[1.5]", None, True),
    ("binary", "[null]", None, True), ("binary", "7", None, True), ("binary", '{"k": 1}', None, True), ("binary", "null", None, False),
    ("array<int>", "[1, 2]", [1, 2], False), ("array<int>", "[1, null]", [1, None], False), ("array<int>", '[1, "x"]', None, True),
    ("array<int>", "5", None, True),
]


@pytest.mark.parametrize("dtype", sorted({v[0] for v in VALUES}))
def test_values_with_types(spark, dtype):
    cases = [(str(i), json.dumps({"v": json.loads(j)}), want, bad) for i, (t, j, want, bad) in enumerate(VALUES) if t == dtype]
    recs = parse_open_records(spark.createDataFrame([c[:2] for c in cases], "source_id string, t string"), "t", typed=True)
    got = {r.source_id: r for r in conform_open(recs, TargetSpec.of("t", [("v", dtype)])).collect()}
    for unit, text, want, bad in cases:
        value = got[unit].v
        assert (bytes(value) if isinstance(value, bytearray) else value) == want, text
        assert (got[unit][ERROR] is not None) == bad, text


def test_times_with_types(spark):
    rows = [("t", '{"v": "2024-01-02 03:04:05"}'), ("ms", '{"v": 1704164645000}'), ("s", '{"v": 1704164645.5}'), ("no", '{"v": [1]}'), ("bad", '{"v": "x"}')]
    recs = parse_open_records(spark.createDataFrame(rows, "source_id string, t string"), "t", typed=True)
    got = {r.source_id: (str(r.v), r[ERROR] is not None) for r in conform_open(recs, TargetSpec.of("t", [("v", "timestamp_ntz")])).collect()}
    assert got == {"t": ("2024-01-02 03:04:05", False), "ms": ("2024-01-02 03:04:05", False), "s": ("2024-01-02 03:04:05.500000", False),
                   "no": ("None", True), "bad": ("None", True)}


def test_later_field_of_a_name_wins(spark):
    recs = parse_open_records(spark.createDataFrame([("u", '{"zed_a": 1, "ZedA": [7]}')], "source_id string, t string"), "t", typed=True)
    row = conform_open(recs, TargetSpec.of("t", [("zed_a", "binary")])).first()
    assert bytes(row.zed_a) == b"\x07" and row[ERROR] is None


def test_no_byte_array_is_null(spark):
    df = spark.createDataFrame([(None,), ([],), ([1, -1],), ([1, None],)], "a array<tinyint>")
    value, error = binary_from_bytes(F.col("a"))
    got = [(r[0] if r[0] is None else bytes(r[0]), r[1] is not None) for r in df.select(value, error).collect()]
    assert got == [(None, False), (b"", False), (b"\x01\xff", False), (None, True)]
