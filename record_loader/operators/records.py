"""P10 (sub-record selection) and J1 (field-to-column match report)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import normalized_keys
from ..spec import LoadOptions, TargetSpec
from .conform import CORRUPT, ERROR, FIELD, META_COLUMNS, WARNING, field_name
from .paths import parse_path, typed_hits, variant_hits


#: Room for the places of one outer record's hits beside its own position.
PLACES = 1 << 31


def _position(meta) -> Column:
    """The place of hit ``__i``: on its own, or after the outer record's ``pos`` (one number for both;
    a fixed-width decimal, as two longs do not go into one)."""
    i = F.coalesce(F.col("__i"), F.lit(0))
    if "pos" not in meta:
        return i.cast("long")
    return (F.col("pos").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + i).cast("decimal(31,0)")


def select_records(df: DataFrame, path: str, keep=META_COLUMNS, fields: str = "fields") -> DataFrame:
    """Pick the records at ``path`` (:mod:`record_loader.operators.paths`) out of each outer record:
    one row per hit, with its fields, or for open records with types its ``fields`` map.

    ``pos`` becomes the hit's place inside its outer record, after the outer ``pos`` when there is one.
    An outer record without hits, a hit that is null and a hit that is no record keep one row with
    ``_error``, so that their unit is quarantined with a reason; a path that no typed record can have a
    record at (the schema has a scalar there) is an error at once.  The fields of a nested open record
    are in order of their names, so that is the order in which colliding names win.  Open records of
    text have no nested records and are an error here."""
    meta = [m for m in df.columns if m in keep]
    steps = parse_path(path)
    other = [F.col(m) for m in meta if m != "pos"]
    outer = other + ([F.col("pos")] if "pos" in meta else [])
    if fields in df.columns and isinstance(df.schema[fields].dataType, T.MapType):
        if not isinstance(df.schema[fields].dataType.valueType, T.VariantType):
            raise TypeError(f"path {path}: open records need their types (typed=True) to have records inside")
        hits = df.select(*outer, F.col(fields).isNull().alias("__bad"),
                         F.posexplode_outer(variant_hits(F.col(fields), steps)).alias("__i", "__r"))
        hits = hits.withColumn("__f", F.try_variant_get("__r", "$", "map<string,variant>"))
        kind = F.concat(F.lit(f"Path {path} holds a value of type "), F.schema_of_variant("__r"), F.lit(", not a record"))
        error = (F.when(F.col("__bad"), F.lit("Malformed record"))
                 .when(F.col("__r").isNull() | F.is_variant_null("__r"), F.lit(f"No record at path {path}"))
                 .when(F.col("__f").isNull(), kind))
        # a row with an error has no fields of its own, and its error says why
        none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<variant>"))
        return hits.select(*other, _position(meta).alias("pos"), F.coalesce("__f", none).alias(fields), error.alias(ERROR))
    inside = {f.name.removeprefix(FIELD): (F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields
              if f.name not in meta and f.name not in (CORRUPT, ERROR, WARNING)}
    records, dt, others = typed_hits(inside, steps, path)
    errors = [F.col(ERROR)] if ERROR in df.columns else []
    if CORRUPT in df.columns:
        errors.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("Malformed record")))
    errors += [F.when(v.isNotNull(), F.lit(f"Path {path} holds a value of type {t}, not a record")) for v, t in others]
    fault = F.coalesce(*errors, F.lit(None).cast("string"))
    if records is None and others:
        raise TypeError(f"path {path} does not point at a record or an array of records: {others[0][1]}")
    if records is None:
        missed = F.coalesce(fault, F.lit(f"No record at path {path}"))
        return df.select(*outer, F.lit(0).alias("__i"), missed.alias(ERROR)).select(
            *other, _position(meta).alias("pos"), ERROR)
    # zero hits keep one row so the unit can be quarantined with a reason
    hits = df.select(*outer, fault.alias("__fault"), F.posexplode_outer(records).alias("__i", "__r"))
    error = F.coalesce("__fault", F.when(F.col("__r").isNull(), F.lit(f"No record at path {path}")))
    return hits.select(*other, _position(meta).alias("pos"),
                       *[F.col(f"__r.`{f.name}`").alias(field_name(f.name, (*meta, "pos"))) for f in dt.fields],
                       error.alias(ERROR))


def match_report(df: DataFrame, spec: TargetSpec, opts: LoadOptions | None = None,
                 fields: str = "fields") -> DataFrame:
    """For open records: how many records carry each (field, column) pair.

    ``status`` is ``matched``, ``unmatched_field`` (field with no column) or
    ``unmatched_column`` (column no record of the group filled).  The spec
    side is the target's column list, bounded by the table's width, so it is
    broadcast."""
    opts = opts or LoadOptions()
    spark: SparkSession = df.sparkSession
    lookup = spec.lookup(opts.translation, opts.pattern)
    spec_df = spark.createDataFrame([(n, c.name) for n, c in lookup.items()],
                                    "norm string, column_name string")
    norm = F.array_distinct(normalized_keys(F.col(fields), opts.translation, opts.pattern))
    entries = df.select(F.explode(norm).alias("norm"))
    field_counts = entries.groupBy("norm").agg(F.count(F.lit(1)).alias("n_records"))
    spec_df = spec_df.withColumnRenamed("norm", "__cnorm")
    joined = field_counts.join(spec_df, F.col("norm") == F.col("__cnorm"), "full_outer")
    return joined.select(
        F.col("norm").alias("field_name"), F.col("column_name"),
        F.coalesce(F.col("n_records"), F.lit(0)).alias("n_records"),
        F.when(F.col("column_name").isNull(), F.lit("unmatched_field"))
         .when(F.col("n_records").isNull(), F.lit("unmatched_column"))
         .otherwise(F.lit("matched")).alias("status"))
