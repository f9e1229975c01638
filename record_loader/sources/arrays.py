"""One JSON array read by all tasks (S3): records cut out of a file without parsing it as a whole.

Spark's text reader splits a file of any size at the closing braces (``lineSep="}"``), so every task has
the pieces of its byte range.  Where a piece stands (inside a string or not, how deep) depends on all
that precedes it; that is a state which composes, so it is found by a prefix scan over the byte ranges:

1. every piece counts its quotes, and how much deeper it leads if it starts outside a string, and if inside;
2. a byte range sums both up from its own start; ranges are few, and running sums over a file's ranges give
   each its true state, which the pieces add to their place in the range;
3. a record of the array ends where a brace outside strings leads back to depth one; the pieces between two
   ends are one record, put together and parsed on their own.

Nothing larger than a record is ever in one place, a byte range being sorted by its own task.  A file that
does not end where it began (cut off, a quote or bracket too many) is not put together at all; one with
anything but objects in its array is malformed too, as for the whole-file parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .files import OPEN_RECORD, TYPED_RECORD

_STRING = r'"[^"]*(?:"|$)'


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _deeper(text: Column) -> Column:
    """How much deeper a text without strings and closing braces leads."""
    return _count(text, "{[") - _count(text, "]")


def _pieces(raw: DataFrame) -> DataFrame:
    """Quotes of a piece, and the depth it adds when it starts outside (``out``) and inside (``in``) a string."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    return raw.withColumns({
        "quotes": _count(plain, '"'),
        "out": _deeper(F.regexp_replace(plain, _STRING, "")),
        "in": _deeper(F.regexp_replace(F.concat(F.lit('"'), plain), _STRING, ""))})


def read_open_arrays(spark: SparkSession, paths, typed: bool = False) -> DataFrame:
    """Files that hold one JSON array of objects, or one object, as open records: ``source_id``, ``pos``
    (the record's number), ``fields``.

    Same records as the whole-file parse.  A malformed file gives a row with NULL ``fields`` (one alone, or
    one beside its sound records); an empty array, blank text and an empty file give none."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("source_id"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("id"), "value")
    unit = ["source_id", "start"]
    inside = Window.partitionBy(*unit).orderBy("id")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    # the closing brace of a piece counts outside strings only; the file's last piece may have none
    pieces = _pieces(raw).withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    ends_out = lambda h: (F.col("quoted") + F.lit(h) + F.col("quotes")) % 2 == 0
    depth = lambda h: (F.when((F.col("quoted") + F.lit(h)) % 2 == 0, F.col("out")).otherwise(F.col("in"))
                       - ends_out(h).cast("int"))
    pieces = pieces.withColumns({"d0": depth(0), "d1": depth(1)})
    ranges = pieces.groupBy(*unit).agg(
        F.sum("quotes").alias("quotes"), F.sum("d0").alias("d0"), F.sum("d1").alias("d1"),
        F.first("size").alias("size"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("id").alias("last_id"),
        F.min_by(F.col("value").rlike(r"^\s*\["), "id").alias("array"))
    file = Window.partitionBy("source_id")
    upto = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = file.orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.withColumn("h", F.coalesce(F.sum("quotes").over(upto), F.lit(0)) % 2)
    ranges = ranges.withColumn("d", F.when(F.col("h") == 0, F.col("d0")).otherwise(F.col("d1")))
    ranges = ranges.select(
        F.col("source_id").alias("r_id"), F.col("start").alias("r_start"), "h", "d", "last_id",
        F.coalesce(F.sum("d").over(upto), F.lit(0)).alias("depth"),
        F.first("array").over(whole).cast("int").alias("base"),
        (F.lead("start").over(file.orderBy("start")).isNull()).alias("last_range"),
        # with a brace after every piece there would be a byte more than the file has: the last one has none
        (F.sum("bytes").over(whole) > F.col("size")).alias("tail"),
        (F.sum("quotes").over(whole) % 2).alias("odd"), F.sum("d").over(whole).alias("total"))
    # the tail's brace that is not there was counted, where it would have been outside strings
    ranges = ranges.withColumn("sound", (F.col("odd") == 0) & (F.col("total") + F.col("tail").cast("int") == 0))
    broken = ranges.where(F.col("last_range") & ~F.col("sound")).select(
        F.col("r_id").alias("source_id"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast(TYPED_RECORD if typed else OPEN_RECORD).alias("fields"))

    known = ranges.where("sound").select("r_id", "r_start", "h", "depth", "base", "tail", "last_range", "last_id")
    placed = pieces.join(known, (F.col("source_id") == F.col("r_id")) & (F.col("start") == F.col("r_start")))
    is_tail = F.col("tail") & F.col("last_range") & (F.col("id") == F.col("last_id"))
    at = F.col("depth") + F.sum(F.when(F.col("h") == 0, F.col("d0")).otherwise(F.col("d1"))).over(
        inside.rowsBetween(Window.unboundedPreceding, 0))
    closes = (F.col("quoted") + F.col("h") + F.col("quotes")) % 2 == 0
    placed = placed.withColumn("ends", (closes & (at == F.col("base")) & ~is_tail).cast("int"))
    placed = placed.select(*unit, "id", "value", "base", "ends", is_tail.alias("is_tail"),
                           F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("record"))
    counts = placed.groupBy(*unit).agg(F.sum("ends").alias("n"))
    counts = counts.select(F.col("source_id").alias("c_id"), F.col("start").alias("c_start"),
                           F.coalesce(F.sum("n").over(Window.partitionBy("source_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)),
                                      F.lit(0)).alias("earlier"))
    numbered = placed.join(counts, (F.col("source_id") == F.col("c_id")) & (F.col("start") == F.col("c_start")))
    records = numbered.groupBy("source_id", (F.col("earlier") + F.col("record")).alias("pos")).agg(
        F.first("base").alias("base"), F.max("ends").alias("whole"),
        F.array_sort(F.collect_list(F.struct("start", "id", "value"))).alias("pieces"))
    text = F.concat(F.array_join(F.col("pieces.value"), "}"), F.when(F.col("whole") == 1, F.lit("}")).otherwise(F.lit("")))
    return _parsed(records.select("source_id", "pos", "base", "whole", text.alias("text")), typed).unionByName(broken)


def _parsed(records: DataFrame, typed: bool) -> DataFrame:
    """What stands before a record or after the last one must be what an array has there."""
    first, array = F.col("pos") == 0, F.col("base") == 1
    lead = F.when(array & first, F.lit(r"(?s)^\s*\[\s*(\{.*)$")).when(array, F.lit(r"(?s)^\s*,\s*(\{.*)$")).when(first, F.lit(r"(?s)^\s*(\{.*)$"))
    body = F.regexp_extract("text", r"(?s)^\s*[\[,]?\s*(\{.*)$", 1)
    fits = F.coalesce(F.regexp_like("text", lead), F.lit(False))
    rest = F.when(array & first, F.lit(r"^\s*\[\s*\]\s*$")).when(array, F.lit(r"^\s*\]\s*$")).otherwise(F.lit(r"^\s*$"))
    fields = F.when((F.col("whole") == 1) & fits, F.from_json(body, TYPED_RECORD if typed else OPEN_RECORD))
    over = (F.col("whole") == 0) & F.regexp_like("text", rest)
    return records.where(~over).select("source_id", F.col("pos").cast("long").alias("pos"), fields.alias("fields"))
