"""The queue of files as a stream source."""

import os
import shutil

from record_loader import LoadOptions, TargetSpec
from record_loader.sinks import LedgerTarget, read_routes
from record_loader.sources.queue import UnitQueueReader
from record_loader.streaming import load_queue, read_receipts

SCHEMA = "id int, name string, code int"
SPEC = TargetSpec.of("PERSONS", [("id", "int", True), ("name", "string"), ("code", "int")], key=("id",))
ROW = '{"id": %d, "name": "n", "code": 1}\n'


def put(folder, name, text, when):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (when, when))


def names_of(reader, start, end):
    return [[os.path.basename(f[0]) for f in p.value] for p in reader.partitions({"entry": start}, {"entry": end})]


def test_offsets_take_the_oldest_files_first_and_survive_a_restart(tmp_dir):
    src = tmp_dir + "/in"
    options = {"path": src, "log": tmp_dir + "/log", "maxunits": "2"}
    reader = UnitQueueReader(options)
    assert reader.latestOffset() == reader.initialOffset() == {"entry": 0}          # no folder yet
    for k, name in enumerate(["c", "b", "a", "_hidden", ".part"]):
        put(src, name, "", 1000 + k)
    assert reader.latestOffset() == {"entry": 1}
    assert reader.latestOffset() == {"entry": 2}
    again = UnitQueueReader(options)                                                 # a restart
    assert again.latestOffset() == {"entry": 2}
    assert names_of(again, 0, 2) == [["c", "b"], ["a"]]
    put(src, "0", "", 500)                                                           # late, with an old time
    assert again.latestOffset() == {"entry": 3} and names_of(again, 2, 3) == [["0"]]
    with open(tmp_dir + "/log/.000000000004", "w") as f:                             # a driver died while it wrote an entry
        f.write("[[")
    assert UnitQueueReader(options).latestOffset() == {"entry": 3}


def routes_of(spark, path):
    return {os.path.basename(r.source_id): (r.route, r.rows, r.error) for r in read_routes(spark, path).collect()}


def test_every_file_gets_its_route_and_receipt(spark, tmp_dir):
    src, out = tmp_dir + "/in put", tmp_dir + "/out"
    put(src, "one row.json", ROW % 1, 1)
    put(src, "empty.json", "", 2)
    put(src, "blank.json", "\n \n", 3)
    put(src, "bad.json", "{", 4)
    put(src, "two{1}.json", ROW % 2, 5)
    target = LedgerTarget(out + "/target")
    args = (spark, src, SPEC, target, LoadOptions(max_units=2), out + "/ckpt", "q", SCHEMA)
    paths = {"routes_path": out + "/routes", "receipts_path": out + "/receipts"}
    load_queue(*args, **paths)
    put(src, "three.json", ROW % 3, 0)
    load_queue(*args, **paths)
    routes = routes_of(spark, out + "/routes")
    assert {n: r[:2] for n, r in routes.items()} == {
        "one%20row.json": ("success", 1), "empty.json": ("success", 0), "blank.json": ("success", 0), "bad.json": ("failure", 0),
        "two%7B1%7D.json": ("success", 1), "three.json": ("success", 1)}
    assert sorted(r.id for r in target.read(spark).collect()) == [1, 2, 3]
    receipts = read_receipts(spark, out + "/receipts").collect()
    assert len(receipts) == 6 and len({r.batch_id for r in receipts}) == 4


def test_files_that_cannot_be_read_fail_alone(spark, tmp_dir):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    spark.createDataFrame([(1, "a", 1)], SCHEMA).coalesce(1).write.parquet(tmp_dir + "/made")
    os.makedirs(src)
    made = [f for f in os.listdir(tmp_dir + "/made") if f.endswith(".parquet")][0]
    shutil.copy(f"{tmp_dir}/made/{made}", src + "/good.parquet")
    put(src, "broken.parquet", "this is no parquet file", 5)
    put(src, "empty.parquet", "", 6)
    target = LedgerTarget(out + "/target")
    load_queue(spark, src, SPEC, target, LoadOptions(), out + "/ckpt", "q", SCHEMA, fmt="parquet",
               routes_path=out + "/routes", receipts_path=out + "/receipts")
    routes = routes_of(spark, out + "/routes")
    assert {n: r[:2] for n, r in routes.items()} == {"good.parquet": ("success", 1), "broken.parquet": ("failure", 0), "empty.parquet": ("success", 0)}
    assert routes["broken.parquet"][2].startswith("Unit cannot be read")
    assert [r.id for r in target.read(spark).collect()] == [1]


def test_a_file_that_went_away_fails_and_the_batch_loads(spark, tmp_dir):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "gone.json", ROW % 1, 1)
    put(src, "here.json", ROW % 2, 2)
    UnitQueueReader({"path": src, "log": out + "/ckpt/units-listed", "maxunits": "10"}).latestOffset()      # listed, then the driver died
    shutil.move(src + "/gone.json", tmp_dir + "/elsewhere")
    target = LedgerTarget(out + "/target")
    load_queue(spark, src, SPEC, target, LoadOptions(max_units=10), out + "/ckpt", "q", SCHEMA, routes_path=out + "/routes")
    routes = routes_of(spark, out + "/routes")
    assert routes == {"gone.json": ("failure", 0, "Unit is not there any more"), "here.json": ("success", 1, None)}
    shutil.move(src + "/here.json", tmp_dir + "/elsewhere-too")
    put(src, "last.json", ROW % 3, 3)
    UnitQueueReader({"path": src, "log": out + "/ckpt/units-listed", "maxunits": "10"}).latestOffset()
    shutil.move(src + "/last.json", tmp_dir + "/elsewhere-last")
    load_queue(spark, src, SPEC, target, LoadOptions(max_units=10), out + "/ckpt", "q", SCHEMA, routes_path=out + "/routes")
    assert routes_of(spark, out + "/routes")["last.json"][0] == "failure"            # a batch with no file left


def test_open_records_through_the_queue(spark, tmp_dir):
    src, out = tmp_dir + "/in", tmp_dir + "/out"
    put(src, "a.json", '[{"id": 1, "name": "x"}, {"id": 2, "code": 7}]', 1)
    put(src, "none.json", "[]", 2)
    put(src, "empty.json", "", 3)
    target = LedgerTarget(out + "/target")
    load_queue(spark, src, SPEC, target, LoadOptions(), out + "/ckpt", "q", open_records=True, routes_path=out + "/routes")
    assert {n: r[:2] for n, r in routes_of(spark, out + "/routes").items()} == {
        "a.json": ("success", 2), "none.json": ("success", 0), "empty.json": ("success", 0)}
    assert sorted((r.id, r.code) for r in target.read(spark).collect()) == [(1, None), (2, 7)]
