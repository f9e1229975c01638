"""Schema conformance: normalise field names, align fields to the target's
columns by name, null-fill missing columns, convert values, and attach the
per-record error that later quarantines the record's whole unit.

Two record shapes share one contract (meta columns, target columns,
``_error``, ``_warning``):

- *uniform*: a typed DataFrame; names are resolved once, at plan time;
- *open*: a ``fields`` column, ``map<string,string>`` or, with the values'
  types, ``map<string,variant>``; names are resolved per row, for units whose
  records carry different fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import coerce_value, null_to_default
from ..functions.names import (last_value_of, normalize_keys_last_wins, normalize_name,
                               normalized_keys)
from ..spec import LoadOptions, TargetSpec

META_COLUMNS = ("source_id", "pos", "batch_id")
CORRUPT = "_corrupt_record"
ERROR = "_error"
WARNING = "_warning"
#: A record field, or target column, that has the name of a meta column stands under this prefix.
FIELD = "field:"


def _meta(df: DataFrame, keep) -> list[str]:
    keep = META_COLUMNS if keep is None else tuple(keep)
    return [c for c in df.columns if c in keep]


def field_name(name: str, meta=META_COLUMNS) -> str:
    """Where a reader puts the record field ``name`` beside the meta columns."""
    return FIELD + name if name in meta else name


def output_columns(conformed: DataFrame, spec: TargetSpec) -> list[Column]:
    """The target's columns of a conformed frame under their own names."""
    return [F.col(f"`{FIELD + n if FIELD + n in conformed.columns else n}`").alias(n) for n in spec.names]


def spread_records(records: DataFrame, partitions: int) -> DataFrame:
    """Deal records out over ``partitions`` by record identity (``source_id``,
    ``pos``) before the CPU-heavy conversion, for a batch of a few large or
    unsplittable files; 0 leaves them as read.  The identity is unique per
    record, so the spread is even whatever the unit sizes."""
    if not partitions:
        return records
    return records.repartition(partitions, *[c for c in ("source_id", "pos") if c in records.columns])


def join_errors(errs: list[Column]) -> Column:
    """Concatenate the non-null messages; NULL when there are none."""
    if not errs:
        return F.lit(None).cast("string")
    joined = F.concat_ws("; ", *errs)
    return F.when(F.length(joined) > 0, joined)


# The texts of the two messages.
def unmatched_field_message(field: Column | str, spec: TargetSpec, opts: LoadOptions) -> Column:
    cols = ",".join(spec.lookup(opts.translation, opts.pattern).keys())
    prefix = "Normalized " if opts.translation != "NONE" else ""
    f = F.lit(field) if isinstance(field, str) else field
    return F.concat(F.lit("Cannot map field '"), f,
                    F.lit(f"' to any column in the database; {prefix}Columns: {cols}"))


def required_message(column: Column | str) -> Column:
    c = F.lit(column) if isinstance(column, str) else column
    return F.concat(F.lit("Record does not have a value for the Required column '"), c, F.lit("'"))


# P1-P3, P9 (uniform) ----------------------------------------------------------------
def normalize_fields(df: DataFrame, translation: str = "REMOVE_UNDERSCORE",
                     pattern: str | None = None, keep=None) -> DataFrame:
    """Rename record fields to their normalised names; when two fields
    normalise alike, the later one (in field order) wins."""
    meta = _meta(df, keep)
    last: dict[str, str] = {}
    for f in df.columns:
        if f not in meta:
            last[normalize_name(f, translation, pattern)] = f
    return df.select(*[F.col(m) for m in meta],
                     *[F.col(f"`{f}`").alias(n) for n, f in last.items()])


# P4-P8, T1 (uniform) -----------------------------------------------------------------
def conform(df: DataFrame, spec: TargetSpec, opts: LoadOptions | None = None,
            keep=None, spread: int = 0) -> DataFrame:
    """Uniform records -> meta + target columns (table order) + ``_error`` +
    ``_warning``.  Name matching, null-fill and the unmatched-field check are
    decided at plan time from the DataFrame's schema.  An ``_error`` or
    ``_warning`` that the records carry already is kept.  ``spread`` deals
    the records out first (:func:`spread_records`)."""
    opts = (opts or LoadOptions()).validate()
    meta = _meta(df, keep)
    fields = [f for f in df.schema.fields if f.name not in meta and f.name not in (CORRUPT, ERROR, WARNING)]
    by_norm: dict[str, T.StructField] = {}
    for f in fields:
        by_norm[normalize_name(f.name.removeprefix(FIELD), opts.translation, opts.pattern)] = f
    lookup = spec.lookup(opts.translation, opts.pattern)
    df = spread_records(df, spread)

    errors: list[Column] = [F.col(ERROR)] if ERROR in df.columns else []
    warnings: list[Column] = [F.col(WARNING)] if WARNING in df.columns else []
    if CORRUPT in df.columns:
        errors.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("Malformed record")))
    if opts.unmatched_field == "fail":
        # the first one, as raised for a record
        extra = [f.name.removeprefix(FIELD) for n, f in by_norm.items() if n not in lookup]
        errors += [unmatched_field_message(f, spec, opts) for f in extra[:1]]

    out: list[Column] = []
    for norm, col in lookup.items():
        f = by_norm.get(norm)
        if f is None:
            value = F.lit(None).cast(col.dtype)
            if col.required and opts.unmatched_column == "fail":
                errors.append(required_message(col.name))
            elif col.required and opts.unmatched_column == "warn":
                warnings.append(required_message(col.name))
        else:
            value, err = coerce_value(F.col(f"`{f.name}`"), f.dataType, col, opts, f.name)
            errors.append(err)
        value, err = _required_null(value, col, opts)
        if err is not None:
            errors.append(err)
        out.append(value.alias(field_name(col.name, meta)))
    return df.select(*[F.col(m) for m in meta], *out,
                     join_errors(errors).alias(ERROR), join_errors(warnings).alias(WARNING))


def _required_null(value: Column, col, opts: LoadOptions):
    if not col.required or opts.on_null_required == "keep":
        return value, None
    if opts.on_null_required == "default":
        return null_to_default(value, col.dtype), None
    return value, F.when(value.isNull(), F.lit(f"NULL value for required column '{col.name}'"))


# Open records: map<string,string> -----------------------------------------------------
def normalize_open(df: DataFrame, fields: str = "fields", translation: str = "REMOVE_UNDERSCORE",
                   pattern: str | None = None) -> DataFrame:
    """P1/P2/P3/P9 for open records: normalise every map key, later key wins."""
    return df.withColumn(fields, normalize_keys_last_wins(F.col(fields), translation, pattern))


def conform_open(df: DataFrame, spec: TargetSpec, opts: LoadOptions | None = None,
                 fields: str = "fields", keep=None, spread: int = 0) -> DataFrame:
    """Open records -> the same contract as :func:`conform`.  Values are text,
    or carry their types; each column's value is looked up by normalised name,
    per row."""
    opts = (opts or LoadOptions()).validate()
    meta = [m for m in _meta(df, keep) if m != fields]
    lookup = spec.lookup(opts.translation, opts.pattern)
    df = spread_records(df, spread)
    staged = df.select(*[F.col(x) for x in meta], F.col(fields).alias("__f"),
                       normalized_keys(F.col(fields), opts.translation, opts.pattern).alias("__k"),
                       *[F.col(c) for c in (CORRUPT, ERROR, WARNING) if c in df.columns])
    m, keys = F.col("__f"), F.col("__k")
    value_type = df.schema[fields].dataType.valueType
    col_names = F.array(*[F.lit(n) for n in lookup])

    errors: list[Column] = [F.col(ERROR)] if ERROR in df.columns else []
    errors.append(F.when(m.isNull(), F.lit("Malformed record")))
    warnings: list[Column] = [F.col(WARNING)] if WARNING in df.columns else []
    if CORRUPT in df.columns:
        errors.append(F.when(F.col(CORRUPT).isNotNull(), F.lit("Malformed record")))
    if opts.unmatched_field == "fail":
        # the first field without a column, under its own name, as raised for a record
        extra = F.array_position(F.transform(keys, lambda k: F.array_contains(col_names, k)), False)
        name = F.try_element_at(F.map_keys(m), extra.cast("int"))
        errors.append(F.when(extra > 0, unmatched_field_message(name, spec, opts)))
    required = [(n, c.name) for n, c in lookup.items() if c.required]
    if required and opts.unmatched_column in ("fail", "warn"):
        missing = F.concat_ws("','", *[F.when(~F.array_contains(keys, F.lit(n)), F.lit(name))
                                      for n, name in required])
        msg = F.when(m.isNotNull() & (F.length(missing) > 0), required_message(missing))
        (errors if opts.unmatched_column == "fail" else warnings).append(msg)

    out = []
    for n, col in lookup.items():
        raw = last_value_of(m, keys, n)
        value, err = coerce_value(raw, value_type, col, opts, n)
        errors.append(err)
        value, err = _required_null(value, col, opts)
        if err is not None:
            errors.append(err)
        out.append(value.alias(field_name(col.name, meta)))
    return staged.select(*[F.col(x) for x in meta], *out,
                         join_errors(errors).alias(ERROR), join_errors(warnings).alias(WARNING))


def to_open_records(df: DataFrame, keep=None, fields: str = "fields") -> DataFrame:
    """Typed records -> open records: every field becomes a text map entry
    (nested values as JSON), in field order."""
    meta = _meta(df, keep)
    entries = []
    for f in df.schema.fields:
        if f.name in meta:
            continue
        v = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            v = F.to_json(v)
        entries.append(F.struct(F.lit(f.name).alias("key"), v.cast("string").alias("value")))
    return df.select(*[F.col(x) for x in meta], F.map_from_entries(F.array(*entries)).alias(fields))
