"""Streaming query recipes: ``events`` split into record files, loaded by
micro-batches of up to ``MAX_UNITS`` files with ``availableNow``, and the
target read back.  All folders are fresh sub-folders of the shared
checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from ..operators.routing import TransientLoadError
from ..plans.recipes import EVENT_COLS, TS_FMT, events_spec, table
from ..sinks.ledger import LedgerTarget
from ..sinks.targets import PathTarget, fresh_dir, read_routes, shared_dir
from ..spec import LoadOptions
from .load import load_queue, read_receipts, read_record_stream, redrive, stream_load

FILES = 50
MAX_UNITS = 10
EVENT_SCHEMA = ("event_id long, ts string, user_id long, event_type string, value string, "
                "props string")


_FILE_SETS: dict[tuple, str] = {}


def events_to_files(spark: SparkSession, sf: str, bad_errors: bool = False) -> str:
    """Write ``events`` as ``FILES`` JSON-lines files, dealt by their id, at any size.
    With ``bad_errors`` the error events go to files of their own whose
    ``value`` is not a number (so those units fail conversion).

    The file set is a pure function of the table, so one written earlier in
    this session is reused; loads only read it."""
    key = (sf, bad_errors, shared_dir(spark), spark.sparkContext.applicationId)
    if key in _FILE_SETS:
        return _FILE_SETS[key]
    path = fresh_dir(spark, "events-in")
    ev = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", TS_FMT).alias("ts"), "user_id", "event_type",
        F.col("value").cast("string").alias("value"), "props")
    w = lambda df, files: df.repartition(files, "event_id").write.mode("append").json(path)
    if bad_errors:
        w(ev.where(F.col("event_type") != "error"), FILES - 10)
        w(ev.where(F.col("event_type") == "error").withColumn("value", F.lit("n/a")), 10)
    else:
        w(ev, FILES)
    _FILE_SETS[key] = path
    return path


class FlakyTarget:
    """A target whose first ``failures`` appends raise a transient error."""

    def __init__(self, inner, failures: int = 1):
        self.inner, self.left = inner, failures

    @property
    def url(self):
        return self.inner.url

    def append(self, df, opts=None, token=None):
        if self.left > 0:
            self.left -= 1
            raise TransientLoadError("SQLTransientConnectionException: connection reset")
        self.inner.append(df, opts, token=token)

    def read(self, spark, schema=None):
        return self.inner.read(spark, schema)


def _run(spark, src, target, on_failure="route", ckpt=None, routes=None, receipts=None, name="events"):
    stream = read_record_stream(spark, src, EVENT_SCHEMA, max_units=MAX_UNITS)
    q = stream_load(stream, events_spec(), target, LoadOptions(timestamp_format=TS_FMT),
                    checkpoint=ckpt or fresh_dir(spark, "ckpt"), load_name=name,
                    routes_path=routes, receipts_path=receipts, on_failure=on_failure)
    q.awaitTermination()
    return q


def stream_load_q(spark, sf):
    """The loaded events, and what the receipts of their files say was loaded."""
    src = events_to_files(spark, sf)
    target = PathTarget(fresh_dir(spark, "stream-target"), idempotent=True)
    receipts = fresh_dir(spark, "receipts")
    _run(spark, src, target, routes=fresh_dir(spark, "routes"), receipts=receipts)
    said = read_receipts(spark, receipts).agg(F.sum("rows").alias("receipt_rows"))
    return target.read(spark).select(*EVENT_COLS).join(F.broadcast(said))     # one row


def stream_rollback_q(spark, sf):
    """The first micro-batch's insert fails; with rollback the query stops
    without advancing its checkpoint, and the restart replays the batch."""
    src = events_to_files(spark, sf)
    inner = PathTarget(fresh_dir(spark, "rollback-target"), idempotent=True)
    target = FlakyTarget(inner, failures=1)
    ckpt, receipts = fresh_dir(spark, "ckpt"), fresh_dir(spark, "receipts")
    try:
        _run(spark, src, target, "rollback", ckpt, receipts=receipts)
    except StreamingQueryException:
        pass
    _run(spark, src, target, "rollback", ckpt, receipts=receipts)
    return inner.read(spark).select(*EVENT_COLS)


def stream_route_q(spark, sf):
    """Files whose records cannot be converted go to ``failure``; the rest load."""
    src = events_to_files(spark, sf, bad_errors=True)
    target = PathTarget(fresh_dir(spark, "route-target"))
    routes = fresh_dir(spark, "routes")
    _run(spark, src, target, routes=routes)
    return target.read(spark).select(*EVENT_COLS)


def stream_routes_q(spark, sf):
    """K3: the route table itself, per event of a routed file: its route, the
    file's error, and whether the target holds the event."""
    src = events_to_files(spark, sf, bad_errors=True)
    target = PathTarget(fresh_dir(spark, "route-target"))
    routes = fresh_dir(spark, "routes")
    _run(spark, src, target, routes=routes)
    of = read_routes(spark, routes).select("source_id", "route", "error")
    events = spark.read.json(src).select("event_id", F.col("_metadata.file_path").alias("source_id"))
    held = target.read(spark).select("event_id", F.lit(True).alias("held"))
    return (events.join(of, "source_id").join(held, "event_id", "left")
            .select("event_id", "route", "error", F.coalesce("held", F.lit(False)).alias("loaded")))


def redrive_q(spark, sf):
    """Every insert of the first run fails transiently -> all units to
    ``retry``; the re-drive loads them."""
    src = events_to_files(spark, sf)
    inner = PathTarget(fresh_dir(spark, "redrive-target"))
    routes, receipts = fresh_dir(spark, "routes"), fresh_dir(spark, "receipts")
    _run(spark, src, FlakyTarget(inner, failures=10**9), routes=routes, receipts=receipts)
    for _ in range(2):                                # the second call finds nothing to do
        redrive(spark, routes, EVENT_SCHEMA, events_spec(), inner, LoadOptions(timestamp_format=TS_FMT),
                load_name="events-redrive", receipts_path=receipts)
    return inner.read(spark).select(*EVENT_COLS)


def stream_reload_q(spark, sf):
    """Two streams under one load name, each with a checkpoint of its own: the
    second one's batches are neither skipped nor put in place of the first one's."""
    ev = table(spark, sf, "events").select("event_id", F.date_format("ts", TS_FMT).alias("ts"), "user_id", "event_type",
                                           F.col("value").cast("string").alias("value"), "props")
    target, receipts = LedgerTarget(fresh_dir(spark, "reload-target")), fresh_dir(spark, "receipts")
    errors = F.col("event_type") == "error"
    for part in (ev.where(~errors), ev.where(errors)):
        src = fresh_dir(spark, "reload-in")
        part.repartition(FILES // 2, "event_id").write.json(src)
        _run(spark, src, target, routes=fresh_dir(spark, "routes"), receipts=receipts, name="again")
    said = read_receipts(spark, receipts).agg(F.sum("rows").alias("receipt_rows"), F.countDistinct("run").alias("streams"))
    return target.read(spark).select(*EVENT_COLS).join(F.broadcast(said))     # one row


class DyingTarget(LedgerTarget):
    """A ledger target whose driver dies once after each of its two writes."""

    def __init__(self, path: str):
        super().__init__(path)
        self.deaths = ["staged", "committed"]

    def append(self, df, opts=None, token=None):
        spark = df.sparkSession
        if self.committed(spark, token) is None:
            attempt, rows = self.stage(df, token)
            if self.deaths[:1] == ["staged"]:
                raise RuntimeError(self.deaths.pop(0))
            self.commit(spark, token, attempt, rows)
            if self.deaths[:1] == ["committed"]:
                raise RuntimeError(self.deaths.pop(0))
            return rows
        return super().append(df, opts, token)


def stream_ledger_q(spark, sf):
    """The driver dies after staging a batch, and again after committing it; the
    restarts load every event once, whatever was left behind."""
    src = events_to_files(spark, sf)
    target = DyingTarget(fresh_dir(spark, "ledger-target"))
    ckpt, receipts = fresh_dir(spark, "ckpt"), fresh_dir(spark, "receipts")
    for _ in range(3):
        try:
            _run(spark, src, target, "rollback", ckpt, receipts=receipts)
        except StreamingQueryException:
            pass
    removed = target.recover(spark, older_than_seconds=0)
    rows = read_receipts(spark, receipts).agg(F.sum("rows").alias("receipt_rows"))
    return target.read(spark).select(*EVENT_COLS, F.lit(removed).cast("long").alias("half_done")).join(F.broadcast(rows))   # one row


def redrive_twice_q(spark, sf):
    """Re-drives whose routes go to a table of their own: the second call finds nothing to do."""
    src = events_to_files(spark, sf)
    inner = PathTarget(fresh_dir(spark, "redrive-target"))
    routes, again, receipts = fresh_dir(spark, "routes"), fresh_dir(spark, "routes-again"), fresh_dir(spark, "receipts")
    _run(spark, src, FlakyTarget(inner, failures=10**9), routes=routes, receipts=receipts)
    calls = [len(redrive(spark, routes, EVENT_SCHEMA, events_spec(), inner, LoadOptions(timestamp_format=TS_FMT, max_units=25),
                         load_name="events-redrive", receipts_path=receipts, new_routes_path=again)) for _ in range(2)]
    said = read_routes(spark, again).where("route = 'success'").agg(F.sum("rows").alias("route_rows"))
    return (inner.read(spark).select(*EVENT_COLS, F.lit(calls[0]).cast("long").alias("first_call"), F.lit(calls[1]).cast("long").alias("second_call"))
            .join(F.broadcast(said)))     # one row


def stream_units_q(spark, sf):
    """A queue with five empty files among its record files: each file has one receipt, and a second run over the
    same checkpoint finds nothing to do."""
    src = fresh_dir(spark, "units-in")
    (table(spark, sf, "events").select("event_id", F.date_format("ts", TS_FMT).alias("ts"), "user_id", "event_type",
                                       F.col("value").cast("string").alias("value"), "props")
     .repartition(FILES // 2, "event_id").write.json(src))
    for k in range(5):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{src}/nothing-{k}.json")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path).close()
    target, receipts = LedgerTarget(fresh_dir(spark, "units-target")), fresh_dir(spark, "receipts")
    ckpt, routes = fresh_dir(spark, "ckpt"), fresh_dir(spark, "routes")
    for _ in range(2):
        load_queue(spark, src, events_spec(), target, LoadOptions(timestamp_format=TS_FMT, max_units=MAX_UNITS), ckpt, "units",
                   schema=EVENT_SCHEMA, routes_path=routes, receipts_path=receipts)
    said = read_receipts(spark, receipts).agg(F.sum("rows").alias("receipt_rows"), F.count(F.lit(1)).alias("units"),
                                              F.count_if(F.col("rows") == 0).alias("empty_units"), F.countDistinct("batch_id").alias("batches"))
    return target.read(spark).select(*EVENT_COLS).join(F.broadcast(said))     # one row


_EVENTS_SQL = "SELECT " + ", ".join(EVENT_COLS) + " FROM events"
SQL_STREAMING = {
    "stream_load": "SELECT " + ", ".join(EVENT_COLS) + ", (SELECT count(*) FROM events) AS receipt_rows FROM events",
    "stream_routes": """SELECT event_id, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS route,
        CASE WHEN event_type = 'error' THEN 'Cannot convert field ''value'' of type string to double for column ''value''' END AS error,
        event_type <> 'error' AS loaded FROM events""",
    "stream_rollback": _EVENTS_SQL,
    "stream_route": _EVENTS_SQL + " WHERE event_type <> 'error'",
    "redrive": _EVENTS_SQL,
    "stream_reload": "SELECT " + ", ".join(EVENT_COLS) + ", (SELECT count(*) FROM events) AS receipt_rows, 2 AS streams FROM events",
    "stream_ledger": "SELECT " + ", ".join(EVENT_COLS) + ", 1 AS half_done, (SELECT count(*) FROM events) AS receipt_rows FROM events",
    "stream_units": "SELECT " + ", ".join(EVENT_COLS) + """, (SELECT count(*) FROM events) AS receipt_rows, 30 AS units,
        5 AS empty_units, 3 AS batches FROM events""",
    "redrive_twice": "SELECT " + ", ".join(EVENT_COLS) + """, 2 AS first_call, 0 AS second_call,
        (SELECT count(*) FROM events) AS route_rows FROM events""",
}
