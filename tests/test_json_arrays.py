"""One JSON array cut into records by all tasks, against the parse of the whole file."""

import json
import os
import random

import pytest

from record_loader.plans.load import load_batch
from record_loader.sources.arrays import read_open_arrays
from record_loader.sinks.targets import PathTarget
from record_loader.sources.files import list_units, read_open_records
from record_loader.spec import TargetSpec

CASES = {
    "plain": '[{"a": 1}, {"a": 2, "b": "x"}]',
    "braces_in_text": '[{"a": "}{][,\\"}"}, {"a": "\\\\", "b": "}"}, {"c": "\\\\\\""}]',
    "nested": '[{"a": {"b": [{"c": 1}, {"c": 2}]}}, {"a": []}, {"a": {}}, {}]',
    "spaces": ' \n[ \n{"a"\t: 1 }\n ,\r\n {"a": 2}\n ] \n',
    "one_object": '{"a": {"b": 1}}',
    "one_object_spaces": '\n {"a": "]"} \n',
    "empty_array": "[]", "empty_array_spaces": " [ \n ] ", "blank": "  \n ", "empty": "",
    "text": '[{"a": "ä€😀\\u007d", "b": "line\\nbreak"}, {"a": null}]',
    "later_field_wins": '[{"a": 1, "a": 2}]',
}
BROKEN = {
    "cut": '[{"a": 1}, {"a": 2}', "cut_in_record": '[{"a": 1}, {"a": ', "cut_in_text": '[{"a": 1}, {"a": "x}]',
    "one_bracket_more": '[{"a": 1}]]', "two_arrays": '[{"a": 1}][{"a": 2}]', "two_objects": '{"a": 1}{"a": 2}',
    "numbers": "[1, 2]", "number_between": '[{"a": 1}, 5, {"a": 2}]', "inner_array": '[[{"a": 1}], {"a": 2}]',
    "no_comma": '[{"a": 1} {"a": 2}]', "trailing": '[{"a": 1}] x', "word": "hello", "bad_record": '[{"a": 1}, {"a" 2}]',
    "brace_first": "}", "comma_last": '[{"a": 1},]',
}


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w", newline="") as f:
        f.write(text)


def rows_of(df):
    out = {}
    for r in df.collect():
        fields = None if r.fields is None else dict(r.fields)
        out.setdefault(os.path.basename(r.source_id), []).append((r.pos, fields))
    return {k: sorted(v, key=lambda x: x[0]) for k, v in out.items()}


@pytest.fixture
def small_splits(spark):
    """Byte ranges of some bytes, so that every state crosses borders."""
    keys = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_same_as_whole_file(spark, tmp_dir):
    for name, text in CASES.items():
        write(f"{tmp_dir}/in", name, text)
    got, want = rows_of(read_open_arrays(spark, f"{tmp_dir}/in")), rows_of(read_open_records(spark, f"{tmp_dir}/in"))
    assert got == want
    assert len(got) == len(CASES) - 4 and all(f is not None for rows in got.values() for _, f in rows)


def test_same_over_many_splits(small_splits, tmp_dir):
    for name, text in CASES.items():
        write(f"{tmp_dir}/in", name, text)
    got, want = (rows_of(f(small_splits, f"{tmp_dir}/in")) for f in (read_open_arrays, read_open_records))
    assert got == want


@pytest.mark.parametrize("splits", ["many", "one"])
def test_broken_files_have_a_record_without_fields(spark, tmp_dir, splits, request):
    if splits == "many":
        request.getfixturevalue("small_splits")
    for name, text in BROKEN.items():
        write(f"{tmp_dir}/in", name, text)
    got = rows_of(read_open_arrays(spark, f"{tmp_dir}/in"))
    assert {k for k, v in got.items() if any(f is None for _, f in v)} == {f"{k}.json" for k in BROKEN}


def test_whole_and_split_files_load_alike(spark, tmp_dir):
    for name, text in {**CASES, **BROKEN}.items():
        write(f"{tmp_dir}/in", name, text)
    spec = TargetSpec.of("t", [("a", "string"), ("b", "string"), ("c", "string")])
    routes = []
    for split in (False, True):
        recs = read_open_records(spark, f"{tmp_dir}/in", split=split)
        units = load_batch(recs, spec, PathTarget(f"{tmp_dir}/out{split}"), open_records=True, units=list_units(spark, f"{tmp_dir}/in")).units
        routes.append({os.path.basename(r.source_id): (r.route, r.rows) for r in units.collect()})
    good = {f"{k}.json" for k in CASES}
    for got in routes:
        assert {k for k, v in got.items() if v[0] == "success"} >= good
    assert {k for k, v in routes[1].items() if v[0] == "success"} == good
    assert {k: v for k, v in routes[0].items() if k in good} == {k: v for k, v in routes[1].items() if k in good}
    # text after the array is not seen by the whole-file parse; the split one sees it
    assert {k for k in routes[0] if routes[0][k] != routes[1][k]} <= {"one_bracket_more.json", "trailing.json", "two_arrays.json", "inner_array.json",
                                                                     "number_between.json", "comma_last.json", "bad_record.json", "numbers.json"}


def test_random_arrays(small_splits, tmp_dir):
    rng = random.Random(5)

    def value(depth):
        kind = rng.randrange(6 if depth else 4)
        if kind == 4:
            return {f"k{i}": value(depth - 1) for i in range(rng.randrange(4))}
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return [rng.randrange(10 ** 6), None, rng.random() < 0.5, "".join(rng.choice('ab"\\{}[],: \n') for _ in range(rng.randrange(9)))][kind]
    for i in range(12):
        records = [{f"f{j}": value(3) for j in range(rng.randrange(1, 5))} for _ in range(rng.randrange(12))]
        write(f"{tmp_dir}/in", f"r{i}", json.dumps(records, indent=rng.choice([None, 1])))
    got, want = (rows_of(f(small_splits, f"{tmp_dir}/in")) for f in (read_open_arrays, read_open_records))
    assert got == want


def test_values_with_types_from_split_arrays(small_splits, tmp_dir):
    write(f"{tmp_dir}/in", "a", '[{"a": [1, 2], "b": "}"}, {"a": {"x": 1}}]')
    rows = read_open_arrays(small_splits, f"{tmp_dir}/in", typed=True).orderBy("pos")
    assert [r.a for r in rows.selectExpr("schema_of_variant(fields['a']) AS a").collect()] == ["ARRAY<BIGINT>", "OBJECT<x: BIGINT>"]
