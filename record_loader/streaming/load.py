"""Streaming intake and micro-batch load.

A file stream is the queue: each trigger takes up to ``max_units`` new files
(``maxFilesPerTrigger``), and ``foreachBatch`` runs one batch load on them.
``availableNow`` drains the queue in bounded batches and stops, which is
also how a directory is loaded in batch mode.

Replay safety: a micro-batch is known by (load name, query id, batch id).
The query id belongs to the checkpoint: a restart keeps it, and a new
checkpoint under a used load name is another stream, whose batches are never
taken for earlier ones.  Routes and receipts of a micro-batch stand in folders
of its own, which a replay rewrites; the receipts come last, and a replayed
batch whose receipts exist is skipped.  Rollback-on-failure raises inside
``foreachBatch`` so the checkpoint does not advance and a restart replays the
same files.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import CORRUPT, field_name
from ..operators.routing import is_transient
from ..plans.load import LoadResult, load_batch
from ..sinks.targets import batch_folder, load_folder, named_loads, read_routes, write_routes
from ..sources.files import OPEN_RECORD, TYPED_RECORD, has_record, open_rows, parse_records
from ..sources.queue import unit_stream
from ..spec import LoadOptions, TargetSpec

# Receipt columns: load_name, run and batch_id (folders), source_id, route, rows,
# error, destination, attempt.

#: Fixed value: the local property in which Spark names the running query.
QUERY_ID = "sql.streaming.queryId"


def read_record_stream(spark: SparkSession, path: str, schema=None, fmt: str = "json",
                       max_units: int = 1000, open_records: bool = False,
                       lines: bool = False, typed: bool = False, **options) -> DataFrame:
    """A stream of record files; ``max_units`` = 0 takes every new file.

    Typed records get ``source_id`` (the file) and ``pos``; with
    ``open_records`` each file is one unit of ``map<string,string>`` records:
    one JSON array or object, or with ``lines`` an object per line, split and
    parsed line by line; with ``typed`` their values keep their types."""
    r = spark.readStream
    if max_units:
        r = r.option("maxFilesPerTrigger", int(max_units))
    for k, v in options.items():
        r = r.option(k, v)
    if open_records and lines:
        raw = r.format("text").load(path).where(has_record("value"))
        return raw.select(F.col("_metadata.file_path").alias("source_id"), F.from_json("value", TYPED_RECORD if typed else OPEN_RECORD).alias("fields"))
    if open_records:
        raw = r.format("text").option("wholetext", "true").load(path)
        return raw.select(F.col("_metadata.file_path").alias("source_id"), open_rows(F.col("value"), typed))
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if fmt == "json" and not options.get("multiLine"):
        # JSON lines: parsed in the plan; malformed lines keep _corrupt_record
        raw = r.format("text").load(path)
        raw = raw.select(F.col("_metadata.file_path").alias("source_id"), "value").where(has_record("value"))
        return parse_records(raw, "value", schema, keep=["source_id"])
    if fmt in ("json", "csv") and CORRUPT not in schema.names:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = r.format(fmt).schema(schema).load(path)
    # positions are assigned per micro-batch (see batch_loader)
    return df.select(F.col("_metadata.file_path").alias("source_id"),
                     *[F.col(f"`{c}`").alias(field_name(c)) for c in df.columns])


def _committed(spark: SparkSession, receipts_path: str | None, load_name: str, batch_id: int, run: str | None = None) -> bool:
    """A micro-batch is committed when its receipt folder exists.  The check
    resolves one path (no scan of earlier receipts, no job).  Only a path
    that is not there means "not committed"; a store that cannot be read
    raises, because loading again could double rows."""
    if not receipts_path:
        return False
    try:
        spark.read.schema("source_id string").parquet(batch_folder(receipts_path, load_name, batch_id, run))
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def write_receipts(units: DataFrame, receipts_path: str, load_name: str, batch_id: int, run: str | None = None) -> None:
    """The receipts of one batch, in its own folder (rewritten by a replay);
    written last, by one job, so a folder that exists is whole."""
    (units.drop("load_name", "run", "batch_id").write.mode("overwrite")
     .parquet(batch_folder(receipts_path, load_name, batch_id, run)))


def read_receipts(spark: SparkSession, receipts_path: str) -> DataFrame:
    return named_loads(spark.read.parquet(receipts_path))


def batch_loader(spec: TargetSpec, target, opts: LoadOptions, load_name: str,
                 routes_path: str | None = None, receipts_path: str | None = None,
                 open_records: bool = False, on_failure: str = "route",
                 dedupe_version=None, attempt: int = 1, run_id: str | None = None, read_units=None):
    """The ``foreachBatch`` function of a stream load (X1-X3).  ``run_id``
    stands for the query id where no stream runs the function.  Where the
    stream's rows are files, ``read_units`` turns them into their records, the
    table of units, and the failure routes of files that cannot be read."""
    if on_failure not in ("route", "rollback"):
        raise ValueError("on_failure must be 'route' or 'rollback'")
    opts = opts.with_(rollback_on_failure=(on_failure == "rollback")).validate()

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = run_id or spark.sparkContext.getLocalProperty(QUERY_ID)
        if _committed(spark, receipts_path, load_name, batch_id, stream):
            return                                   # replayed batch, already loaded
        listed = unread = None
        if read_units is not None:
            batch, listed, unread = read_units(batch)
        if "pos" not in batch.columns:
            batch = batch.withColumn("pos", F.monotonically_increasing_id())
        result = load_batch(batch.withColumn("batch_id", F.lit(batch_id).cast("long")),
                            spec, target, opts, open_records=open_records, batch_id=batch_id, units=listed,
                            dedupe_version=dedupe_version, token=f"{load_name}-{stream}-{batch_id}" if stream else f"{load_name}-{batch_id}")
        try:
            if not result.n_units and unread is None:
                return                               # empty queue: no-op
            units = result.receipts(load_name, target.url, attempt)
            if unread is not None:
                units = units.unionByName(unread.select(
                    F.lit(load_name).alias("load_name"), F.lit(batch_id).cast("long").alias("batch_id"), "source_id",
                    F.lit("failure").alias("route"), F.lit(0).cast("long").alias("rows"), "error",
                    F.lit(target.url).alias("destination"), F.lit(attempt).cast("int").alias("attempt")))
            if routes_path:
                write_routes(units, routes_path, load_name, batch_id, run=stream)
            if receipts_path:
                write_receipts(units, receipts_path, load_name, batch_id, stream)
        finally:
            result.release()
    return run


def stream_load(stream: DataFrame, spec: TargetSpec, target, opts: LoadOptions,
                checkpoint: str, load_name: str, routes_path: str | None = None,
                receipts_path: str | None = None, open_records: bool = False,
                on_failure: str = "route", trigger: str = "availableNow",
                dedupe_version=None, attempt: int = 1):
    """Start the micro-batch load; returns the ``StreamingQuery``.

    ``trigger``: ``availableNow`` (drain and stop) or a processing-time
    interval such as ``'10 seconds'``."""
    fn = batch_loader(spec, target, opts, load_name, routes_path, receipts_path,
                      open_records, on_failure, dedupe_version, attempt)
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()


def load_directory(spark: SparkSession, path: str, spec: TargetSpec, target, opts: LoadOptions,
                   checkpoint: str, load_name: str, schema=None, fmt: str = "json",
                   open_records: bool = False, routes_path: str | None = None,
                   receipts_path: str | None = None, on_failure: str = "route", **options):
    """B1 for a folder of record files: drain it in batches of up to
    ``opts.max_units`` files (0 = one batch), one load per batch, and stop.
    The same checkpoint makes a rerun pick up only files not loaded yet."""
    stream = read_record_stream(spark, path, schema, fmt, opts.max_units, open_records, **options)
    q = stream_load(stream, spec, target, opts, checkpoint, load_name, routes_path, receipts_path,
                    open_records, on_failure, "availableNow")
    q.awaitTermination()
    return q


def unit_reader(spark: SparkSession, schema=None, fmt: str = "json", open_records: bool = False, **reader):
    """The ``read_units`` of :func:`batch_loader`: the files of a micro-batch, by name.  The names of one batch
    (``max_units``) reach the driver, for the reader.  A file that went away since it was listed, or whose format
    cannot be read at all, is a unit that fails; the others load."""
    from ..sources.files import read_open_records, read_records
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def read(paths):
        names = [_literal(p) for p in paths]
        if open_records:
            return read_open_records(spark, names, **reader)
        return read_records(spark, names, fmt, schema, **reader)

    def units_of(batch):
        present, unread, footers = {}, [], {}
        for (path,) in batch.select("path").collect():
            p = path_of(path)
            fs = p.getFileSystem(conf)
            # as scans name it
            name = re.sub("^([A-Za-z0-9+.-]+):///", r"\1:/", fs.makeQualified(p).toUri().toString())
            if not fs.exists(p):
                unread.append((name, "Unit is not there any more"))
                continue
            present[name] = path
            if fmt in FOOTER_FORMATS and not open_records and fs.getFileStatus(p).getLen():
                footers[path] = name
        for path, error in _unreadable(spark, fmt, list(footers)):
            del present[footers[path]]
            unread.append((footers[path], error))
        listed = spark.createDataFrame([(n,) for n in present], "source_id string")
        failed = spark.createDataFrame(unread, "source_id string, error string") if unread else None
        records = read(list(present.values())) if present else _no_records(spark, schema, open_records, reader)
        return records, listed, failed
    return units_of


#: Formats whose files carry their schema, so that a file may not be readable at all.
FOOTER_FORMATS = ("parquet", "orc")


def _unreadable(spark: SparkSession, fmt: str, paths: list) -> list:
    """(path, error) of the files whose footers cannot be read: one job reads the footers of all files; only where
    it fails are the files halved until the broken ones stand alone."""
    if not paths:
        return []
    try:
        spark.read.format(fmt).option("mergeSchema", "true").load([_literal(p) for p in paths])
        return []
    except (PySparkException, Py4JJavaError) as e:
        if is_transient(e):
            raise                                    # the batch is replayed
        if len(paths) == 1:
            return [(paths[0], f"Unit cannot be read: {_condition(e)}")]
    half = len(paths) // 2
    return _unreadable(spark, fmt, paths[:half]) + _unreadable(spark, fmt, paths[half:])


def _condition(e) -> str:
    """The innermost error condition that Spark names; else the class of the error."""
    if isinstance(e, PySparkException):
        return e.getCondition() or type(e).__name__
    named, cause = None, e.java_exception
    while cause is not None:
        try:
            named = cause.getCondition() or named
        except Exception:  # noqa: BLE001 - not one of Spark's
            pass
        cause = cause.getCause()
    return named or e.java_exception.getClass().getSimpleName()


def _no_records(spark: SparkSession, schema, open_records: bool, reader: dict) -> DataFrame:
    if open_records:
        return spark.createDataFrame([], f"source_id string, pos long, fields {TYPED_RECORD if reader.get('typed') else OPEN_RECORD}")
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema or T.StructType()
    own = [T.StructField("source_id", T.StringType()), T.StructField("pos", T.LongType())]
    return spark.createDataFrame([], T.StructType(own + [T.StructField(field_name(f.name), f.dataType) for f in fields.fields]))


def load_queue(spark: SparkSession, path: str, spec: TargetSpec, target, opts: LoadOptions, checkpoint: str, load_name: str,
               schema=None, fmt: str = "json", open_records: bool = False, routes_path: str | None = None,
               receipts_path: str | None = None, on_failure: str = "route", trigger: str = "drain", **reader):
    """X1 over :func:`unit_stream`: every file of a folder gets its route and receipt, files without a record and
    files that cannot be read too.  Batches of up to ``opts.max_units`` files, oldest first.  ``trigger``: ``drain``
    (load what is there, then stop) or a processing-time interval; returns the query."""
    fn = batch_loader(spec, target, opts, load_name, routes_path, receipts_path, open_records, on_failure,
                      read_units=unit_reader(spark, schema, fmt, open_records, **reader))
    units = unit_stream(spark, path, f"{checkpoint.rstrip('/')}/units-listed", opts.max_units)
    w = units.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    query = w.trigger(processingTime="0 seconds" if trigger == "drain" else trigger).start()
    if trigger == "drain":
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return query


def unit_states(routes: DataFrame) -> DataFrame:
    """(source_id, route, attempt): the latest route of every unit, by attempt."""
    return (routes.groupBy("source_id")
            .agg(F.max(F.struct("attempt", "batch_id", "route")).alias("last"))
            .select("source_id", "last.route", "last.attempt"))


def file_path(source_id: str) -> str:
    """The path of a unit's file, as a reader takes it: units are named by URL
    (space as %20), readers take plain paths in which glob characters are escaped."""
    return _literal(unquote(source_id))


def _literal(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _routes_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_routes(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _run_committed(spark: SparkSession, receipts_path: str | None, load_name: str, run: str) -> bool:
    """Receipts of a re-drive's run exist, whatever number its batch had."""
    if not receipts_path:
        return False
    try:
        spark.read.schema("source_id string").parquet(load_folder(receipts_path, load_name, run))
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def redrive(spark: SparkSession, routes_path: str, schema, spec: TargetSpec, target,
            opts: LoadOptions, load_name: str, receipts_path: str | None = None,
            max_attempts: int = 3, fmt: str = "json", open_records: bool = False,
            new_routes_path: str | None = None, **reader) -> list[LoadResult]:
    """Attempt the units whose latest route is ``retry`` again, in batches
    of ``opts.max_units`` (the file names of one batch reach the driver, for
    the reader).  Every unit counts its own attempts; units that have used up
    ``max_attempts`` go to ``failure``.  A unit that has succeeded since is
    left alone, so a second call has nothing to do.

    A batch's token is made of its units and their attempts: repeated after
    a crash, it names the same load, which targets that know tokens do once,
    and which is skipped if its receipts exist.  With ``new_routes_path`` the
    routes of both tables count, so a second call finds nothing to do either.
    ``reader`` holds the reader's options (CSV header, ``multiLine``, formats),
    the same as in the first attempt.  Returns the results, one per batch."""
    from ..operators.batches import plan_batches
    from ..sources.files import read_open_records, read_records

    routes = read_routes(spark, routes_path)
    if new_routes_path:
        later = _routes_if_any(spark, new_routes_path)
        routes = routes if later is None else routes.unionByName(later, allowMissingColumns=True)
    states = unit_states(routes).where(F.col("route") == "retry")
    out_routes = new_routes_path or routes_path
    last = routes.agg(F.max("batch_id")).first()[0] or 0
    spent = states.where(F.col("attempt") >= max_attempts).select(
        "source_id", F.lit("failure").alias("route"), F.lit(0).cast("long").alias("rows"),
        F.lit("retry attempts exhausted").alias("error"), F.lit(target.url).alias("destination"),
        (F.col("attempt") + 1).cast("int").alias("attempt")).checkpoint()
    due = plan_batches(states.where(F.col("attempt") < max_attempts), opts.max_units, ("source_id",), ()).checkpoint()
    if not spent.isEmpty():
        write_routes(spent, out_routes, load_name, last + 1, run="spent")
    count = due.agg(F.max("batch_id")).first()[0]
    results = []
    for k in range(0 if count is None else count + 1):
        some = due.where(F.col("batch_id") == k).select("source_id", "attempt")
        units = sorted((r.source_id, r.attempt) for r in some.collect())     # at most max_units names
        run = f"again-{hashlib.md5(repr(units).encode()).hexdigest()[:16]}"
        token = f"{load_name}-{run}"
        number = last + 1 + k
        if _run_committed(spark, receipts_path, load_name, run):
            continue                                 # loaded before a crash took its routes
        paths = [file_path(u) for u, _ in units]
        records = read_open_records(spark, paths, **reader) if open_records else read_records(spark, paths, fmt, schema, **reader)
        result = load_batch(records, spec, target, opts, open_records=open_records, batch_id=number, token=token,
                            units=some.select("source_id"))
        attempts = some.select("source_id", (F.col("attempt") + 1).cast("int").alias("attempt"))
        done = result.receipts(load_name, target.url).drop("attempt").join(attempts, "source_id")
        write_routes(done, out_routes, load_name, number, run=run)
        if receipts_path:
            write_receipts(done, receipts_path, load_name, number, run)
        results.append(result)
    return results
