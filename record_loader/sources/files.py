"""Record sources (S1-S4): record files read as a batch, each record tagged
with its unit (``source_id`` = the file) and position inside the unit.

- ``read_records``: typed records from JSON / CSV / Parquet / ORC files.
- ``read_open_records``: one whole file per unit, parsed into an array of
  ``map<string,string>`` records, for units whose records differ in fields.
- ``parse_records`` / ``parse_open_records``: the same two parses over a
  text column of an existing DataFrame (records already in a table).

Malformed input quarantines its unit: a corrupt row flags the unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.conform import CORRUPT, META_COLUMNS, field_name

FORMATS = ("json", "csv", "parquet", "orc", "avro")
OPEN_RECORD = "map<string,string>"
#: open records whose values keep their JSON types
TYPED_RECORD = "map<string,variant>"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_records(spark: SparkSession, paths, fmt: str = "json", schema=None,
                 multi_line: bool | None = None, on_malformed: str = "quarantine",
                 date_format: str | None = None, timestamp_format: str | None = None,
                 **options) -> DataFrame:
    """Read record files: rows + ``source_id`` (file path) + ``pos``.

    ``pos`` is the row's index in its file where the format keeps it
    (``_metadata.row_index`` for Parquet); elsewhere a monotonically
    increasing id gives a stable order within the file.  With ``on_malformed='quarantine'`` JSON / CSV keep corrupt
    rows in ``_corrupt_record`` (the unit is later quarantined)."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}")
    if (fmt == "json" and not multi_line and schema is not None and on_malformed == "quarantine"
            and not options):
        # JSON lines: parse the text in the plan, so the corrupt-record column
        # is an ordinary column (no scan-level restrictions on it)
        raw = spark.read.text(_paths(paths))
        raw = raw.select(F.col("_metadata.file_path").alias("source_id"),
                         F.monotonically_increasing_id().alias("pos"), "value").where(has_record("value"))
        return parse_records(raw, "value", schema, keep=["source_id", "pos"],
                             date_format=date_format, timestamp_format=timestamp_format)
    reader = spark.read.format(fmt)
    if schema is not None:
        if isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        if fmt in ("json", "csv") and on_malformed == "quarantine" and CORRUPT not in schema.names:
            schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    if fmt == "json" and multi_line is not None:
        reader = reader.option("multiLine", str(bool(multi_line)).lower())
    if fmt in ("json", "csv"):
        reader = reader.option("mode", "PERMISSIVE" if on_malformed == "quarantine" else "FAILFAST")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        if date_format:
            reader = reader.option("dateFormat", date_format)
        if timestamp_format:
            reader = reader.option("timestampFormat", timestamp_format)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(_paths(paths))
    if fmt == "parquet":
        pos = F.col("_metadata.row_index")
    else:
        pos = F.monotonically_increasing_id()
    return df.select(F.col("_metadata.file_path").alias("source_id"), pos.cast("long").alias("pos"),
                     *[F.col(f"`{c}`").alias(field_name(c)) for c in df.columns])


def trimmed(text: Column) -> Column:
    """Text without the white space that JSON allows around a value."""
    return F.btrim(text, F.lit(" \t\r\n"))


def has_record(text: str) -> Column:
    """A line that is not blank; blank lines separate records and are none."""
    return trimmed(F.col(text)) != ""


def wrap_single(text: Column) -> Column:
    """A unit holding one JSON object is wrapped in ``[ ]`` so one parse
    shape (an array of records) covers both."""
    t = trimmed(text)
    return F.when(F.startswith(t, F.lit("[")), t).otherwise(F.concat(F.lit("["), t, F.lit("]")))


def open_rows(text: Column, typed: bool = False) -> Column:
    """The generator of a unit's records (``pos``, ``fields``): none for an
    empty array or text, one with NULL ``fields`` for text that does not parse."""
    record = TYPED_RECORD if typed else OPEN_RECORD
    malformed = F.array(F.lit(None).cast(record))
    return F.posexplode(F.coalesce(F.from_json(wrap_single(text), f"array<{record}>"), malformed)).alias("pos", "fields")


def parse_open_records(df: DataFrame, text: str, unit: str = "source_id",
                       keep=(), typed: bool = False) -> DataFrame:
    """S3/S4 over a text column: each value is one unit holding a JSON array
    of objects (or one object).  Output: unit, ``pos``, ``fields`` map; a
    unit that does not parse yields one row with NULL ``fields`` (later
    quarantined as malformed).  Nested values stay JSON text; with ``typed``
    every value keeps its type (VARIANT), so byte arrays, arrays and records
    are told from text and record paths reach inside."""
    return df.select(F.col(unit).alias("source_id"), *[F.col(k) for k in keep], open_rows(F.col(text), typed))


def read_open_records(spark: SparkSession, paths, lines: bool = False, typed: bool = False, split: bool = False) -> DataFrame:
    """S3: record files as units of open records.

    With ``lines`` (JSON lines: one object per line) the files are split
    and parsed line by line, whatever their size.  Otherwise a file is one
    JSON array or object, which must be whole to parse, so one row of one
    task: such files should be modest.  ``split`` reads large ones by all
    tasks (:mod:`record_loader.sources.arrays`).  ``typed`` as in
    :func:`parse_open_records`."""
    if split and not lines:
        from .arrays import read_open_arrays
        return read_open_arrays(spark, paths, typed)
    if lines:
        raw = spark.read.text(_paths(paths)).select(
            F.col("_metadata.file_path").alias("source_id"), F.monotonically_increasing_id().alias("pos"), "value")
        return raw.where(has_record("value")).select(
            "source_id", "pos", F.from_json("value", TYPED_RECORD if typed else OPEN_RECORD).alias("fields"))
    raw = spark.read.text(_paths(paths), wholetext=True)
    raw = raw.select(F.col("_metadata.file_path").alias("source_id"), F.col("value"))
    return parse_open_records(raw, "value", typed=typed)


def parse_records(df: DataFrame, text: str, schema, keep=(), date_format: str | None = None,
                  timestamp_format: str | None = None) -> DataFrame:
    """S1 over a text column: one JSON object per value -> typed fields;
    a value that does not parse (or holds a value of the wrong type) leaves
    ``_corrupt_record`` set, which later quarantines its unit."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    fields = [f for f in schema.fields if f.name != CORRUPT]
    full = T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if date_format:
        opts["dateFormat"] = date_format
    if timestamp_format:
        opts["timestampFormat"] = timestamp_format
    parsed = F.from_json(F.col(text), full, opts)
    out = df.select(*[F.col(k) for k in keep], parsed.alias("__r"), F.col(text).alias("__t"))
    corrupt = F.when(F.col("__t").isNotNull() & (F.col("__r").isNull() | F.col(f"__r.{CORRUPT}").isNotNull()),
                     F.col("__t"))
    return out.select(*keep, *[F.col(f"__r.`{f.name}`").alias(field_name(f.name, (*META_COLUMNS, *keep))) for f in fields],
                      corrupt.alias(CORRUPT))


def list_units(spark: SparkSession, paths) -> DataFrame:
    """The unit table: one row per input file with its arrival time (the
    file's modification time) and size; the queue that batches are cut from,
    and the ``units`` of a load.  Reads file metadata only, not contents.
    Scans pass empty files over, so the names come from the reader's own
    listing; an empty file has size 0 and no arrival time."""
    files = spark.read.format("binaryFile").load(_paths(paths))
    known = files.select(F.col("_metadata.file_path").alias("source_id"),
                         F.col("_metadata.file_modification_time").alias("arrival"),
                         F.col("_metadata.file_size").alias("size"))
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "source_id string")
    # the listing writes scheme:///path where rows have scheme:/path
    names = names.select(F.regexp_replace("source_id", "^([A-Za-z0-9+.-]+):///", "$1:/").alias("source_id"))
    return names.join(known, "source_id", "left").withColumn("size", F.coalesce("size", F.lit(0)))
