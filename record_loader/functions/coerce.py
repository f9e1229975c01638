"""Value conversion to a target column's type, as JVM-side Column expressions.

Every converter returns ``(value, error)``: ``error`` is a string Column that is
non-null exactly when the input was non-null and could not be converted.
ANSI mode is on by default in Spark 4, so only ``try_*`` forms are used and
every guard sits inside the ``when`` that needs it.  No Python UDFs: all of
this stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Conv = tuple[Column, Column]

# Fixed values --------------------------------------------------------------
# Integral epoch values below this bound (year 10000 in milliseconds) are read
# as epoch milliseconds, larger ones as epoch microseconds.
EPOCH_MS_LIMIT = 253402300800000
INTEGRAL_RX = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL_RX = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
HEX_RX = r"^([0-9a-fA-F]{2})*$"
UUID_RX = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
NUMERIC = INTEGRAL + FRACTIONAL
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def type_label(dt: T.DataType) -> str:
    return dt.simpleString()


def failed(c: Column, value: Column, message: str | Column) -> Column:
    """Error text when a non-null input produced a null value."""
    msg = message if isinstance(message, Column) else F.lit(message)
    return F.when(c.isNotNull() & value.isNull(), msg)


def _null(dt: T.DataType) -> Column:
    return F.lit(None).cast(dt)


# Text -> number ----------------------------------------------------------
def number_from_string(c: Column, dt: T.DataType, message: str) -> Conv:
    s = F.trim(c)
    if isinstance(dt, INTEGRAL):
        value = F.when(s.rlike(INTEGRAL_RX), s.try_cast(dt))
    else:
        value = s.try_cast(dt)
    return value, failed(c, value, message)


# Text -> binary -------------------------------------------------------
def binary_utf8(c: Column) -> Conv:
    value = F.try_to_binary(c, F.lit("utf-8"))
    return value, failed(c, value, "Cannot encode text as UTF-8")


def binary_hex(c: Column) -> Conv:
    # both cases accepted; odd length is malformed (Spark alone would pad it)
    value = F.when(c.rlike(HEX_RX), F.try_to_binary(c, F.lit("hex")))
    return value, failed(c, value, "Malformed hexadecimal text")


def binary_base64(c: Column) -> Conv:
    value = F.try_to_binary(c, F.lit("base64"))
    return value, failed(c, value, "Malformed Base64 text")


def binary_from_string(c: Column, binary_format: str) -> Conv:
    if binary_format == "hex":
        return binary_hex(c)
    if binary_format == "base64":
        return binary_base64(c)
    return binary_utf8(c)


# Arrays -> binary -----------------------------------------------------
def binary_from_bytes(c: Column) -> Conv:
    """array<tinyint> (signed bytes, as Java holds them) -> the same bytes."""
    hexed = F.concat_ws("", F.transform(
        c, lambda b: F.lpad(F.hex(b.cast("int").bitwiseAND(F.lit(255))), 2, "0")))
    # no array, or one that holds nulls, has no bytes (the text of no array would be empty)
    value = F.when(~F.exists(c, lambda b: b.isNull()), F.unhex(hexed))
    return value, failed(c, value, "Cannot convert a byte array holding nulls to binary")


def binary_reject(c: Column, src: T.DataType) -> Conv:
    """A non-byte array (or any other non-text value) cannot become binary.
    An empty array carries no element to object to and becomes empty bytes."""
    msg = f"Cannot convert value of type {type_label(src)} to binary"
    if isinstance(src, T.ArrayType):
        value = F.when(F.size(c) == 0, F.lit(b"").cast("binary"))
    else:
        value = _null(T.BinaryType())
    return value, failed(c, value, msg)


def binary_of_text(c: Column) -> Conv:
    """Opt-in: any scalar -> UTF-8 bytes of its text.  NULL stays NULL."""
    value = F.encode(c.cast("string"), "UTF-8")
    return value, failed(c, value, "Cannot render value as text")


# Flexible timestamps --------------------------------------------------------
def timestamp_from_epoch(n: Column) -> Column:
    """Integral epoch: milliseconds below year 10000, microseconds above."""
    return F.when(F.abs(n) < F.lit(EPOCH_MS_LIMIT), F.timestamp_millis(n)).otherwise(
        F.timestamp_micros(n))


def timestamp_from_seconds(d: Column) -> Column:
    """Decimal epoch seconds (plain or scientific notation) -> µs, rounded."""
    micros = F.round(d.try_cast("decimal(38,9)") * F.lit(1000000)).try_cast("long")
    return F.timestamp_micros(micros)


# Declared formats that are ISO-8601 shapes: Spark's own string -> timestamp
# cast parses them without the pattern formatter.
ISO_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss",
               "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss")


# Fixed value: text that starts with a year and a month.
DATED_RX = r"^[+-]?\d{4,6}-\d"


def flexible_timestamp(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss.SSSSSS",
                       dt: T.DataType = T.TimestampType()) -> Conv:
    """Text -> timestamp: the declared format, else integral epoch ms / µs,
    else decimal epoch seconds, else any ISO-8601 form Spark knows.

    When the declared format is an ISO shape, text shaped like a date
    (``dddd-``) takes the built-in cast first; it accepts exactly what the
    formatter and the final ISO fallback accept together, only faster."""
    s = F.trim(c)
    if fmt in ISO_FORMATS:
        first = F.when(F.substring(s, 5, 1) == F.lit("-"), s.try_cast("timestamp"))
    else:
        first = F.try_to_timestamp(s, F.lit(fmt))
    value = F.coalesce(
        first,
        F.when(s.rlike(INTEGRAL_RX), timestamp_from_epoch(s.try_cast("long"))),
        F.when(s.rlike(DECIMAL_RX), timestamp_from_seconds(s)),
        # any other ISO form, but never a time alone: that would mean today
        F.when(s.rlike(DATED_RX), F.try_to_timestamp(s)),
    )
    if isinstance(dt, T.TimestampNTZType):
        value = value.cast("timestamp_ntz")
    return value, failed(c, value, f"Cannot parse timestamp with format {fmt}")


def timestamp_from_value(c: Column, src: T.DataType, dt: T.DataType) -> Conv:
    if isinstance(src, INTEGRAL):
        value = timestamp_from_epoch(c.cast("long"))
    elif isinstance(src, FRACTIONAL):
        value = timestamp_from_seconds(c.cast("string"))
    elif isinstance(src, TEMPORAL):
        value = c.cast("timestamp")
    else:
        return _null(dt), failed(c, _null(dt), f"Cannot convert {type_label(src)} to timestamp")
    if isinstance(dt, T.TimestampNTZType):
        value = value.cast("timestamp_ntz")
    return value, failed(c, value, f"Cannot convert {type_label(src)} to timestamp")


# Dates -------------------------------------------------------------------
def date_from_epoch_ms(c: Column) -> Conv:
    """Epoch milliseconds -> the date in the session time zone."""
    value = F.to_date(F.timestamp_millis(c.cast("long")))
    return value, failed(c, value, "Cannot convert epoch milliseconds to date")


def date_from_string(c: Column, fmt: str = "yyyy-MM-dd") -> Conv:
    s = F.trim(c)
    value = F.coalesce(
        F.try_to_date(s, fmt),
        F.when(s.rlike(INTEGRAL_RX), F.to_date(F.timestamp_millis(s.try_cast("long")))),
        F.try_to_date(s),
    )
    return value, failed(c, value, f"Cannot parse date with format {fmt}")


# Text ---------------------------------------------------------------
def to_text(c: Column, src: T.DataType) -> Conv:
    if isinstance(src, (T.StructType, T.MapType, T.ArrayType)):
        return record_to_json(c)
    value = c.cast("string")
    return value, failed(c, value, f"Cannot render {type_label(src)} as text")


def record_to_json(c: Column) -> Conv:
    value = F.to_json(c)
    return value, failed(c, value, "Cannot render record as JSON")


def uuid_to_string(c: Column, check_shape: bool = True) -> Conv:
    s = c.cast("string")
    value = F.when(s.rlike(UUID_RX), s) if check_shape else s
    return value, failed(c, value, "Value is not a UUID")


# Open values with their types (VARIANT) ---------------------------------------------------
def variant_as(value: Column, ddl: str, path: str = "$") -> Column:
    """``value`` as the type ``ddl``; NULL if it is no such value."""
    return F.try_variant_get(value, path, ddl)


def _byte_array(elements: Column) -> Column:
    """An array of whole numbers in the range of a signed byte; NULL for any other array."""
    byte = lambda x: F.when(F.schema_of_variant(x) == "BIGINT", variant_as(x, "tinyint"))
    return F.when(F.forall(elements, lambda x: F.coalesce(byte(x).isNotNull(), F.lit(False))),
                  F.transform(elements, byte))


def value_of_variant(c: Column, col, opts, field: str) -> Conv:
    """A value that brings its own type -> the column's type, by the rules for that type.

    Text goes by the rules of text, whole numbers by those of ``bigint``, and so on; an array is binary
    if it holds nothing but bytes (T6) and is rejected otherwise (T7), and a collection never becomes a
    scalar (T16) but for text, which gets its JSON.  JSON null is NULL."""
    dt = col.dtype
    v = F.when(~F.is_variant_null(c), c)
    elements = variant_as(v, "array<variant>")
    is_record = variant_as(v, "map<string,variant>").isNotNull()
    scalar = elements.isNull() & ~is_record
    # a collection's type would be worked out from all its elements
    kind = F.when(scalar, F.schema_of_variant(v))
    name = F.when(elements.isNotNull(), F.lit("array")).when(is_record, F.lit("record")).otherwise(F.lower(kind))
    message = F.concat(F.lit(f"Cannot convert field '{field}' of type "), name,
                       F.lit(f" to {type_label(dt)} for column '{col.name}'"))
    if isinstance(dt, T.StringType):
        text = F.when(scalar, variant_as(v, "string")).otherwise(F.to_json(v))
        return uuid_to_string(text) if col.uuid else (text, failed(v, text, message))
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        value = variant_as(v, type_label(dt))
        if isinstance(dt, T.ArrayType):
            # an element that does not convert is no NULL of the source's
            lost = F.size(F.filter(value, lambda x: x.isNull())) != F.size(F.filter(elements, F.is_variant_null))
            value = F.when(~lost, value)
        return value, failed(v, value, message)

    def of(source: T.DataType) -> Conv:
        return _coerce(variant_as(v, type_label(source)), source, col, opts, field)

    text, text_error = of(T.StringType())
    if isinstance(dt, T.BinaryType):
        as_bytes, bytes_error = binary_from_bytes(_byte_array(elements))
        other = variant_as(v, "string")
        other = F.encode(other, "UTF-8") if opts.binary_from == "text" else _null(dt)
        value = F.when(kind == "STRING", text).when(elements.isNotNull(), as_bytes).when(scalar, other)
        reject = F.concat(F.lit("Cannot convert value of type "), name, F.lit(" to binary"))
        error = F.when(kind == "STRING", text_error).otherwise(F.coalesce(bytes_error, failed(v, value, reject)))
        return value, error
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        numbers = [(kind == "BIGINT", of(T.LongType()))]
        if not isinstance(dt, T.DateType):
            numbers.append(((kind == "DOUBLE") | kind.startswith("DECIMAL"), of(T.DecimalType(38, 9))))
        value, error = F.when(kind == "STRING", text), F.when(kind == "STRING", text_error)
        for holds, (number, number_error) in numbers:
            value, error = value.when(holds, number), error.when(holds, number_error)
    else:
        value = F.when(kind == "STRING", text).when(scalar, variant_as(v, type_label(dt)))
        error = F.when(kind == "STRING", text_error)
    return value, F.coalesce(error, failed(v, value, message))


# Enum ---------------------------------------------------------------------------
def enum_check(c: Column, values, column: str = "") -> Conv:
    s = c.cast("string")
    value = F.when(s.isin(list(values)), s)
    return value, failed(c, value, f"Value for column '{column}' is not one of "
                                   f"{', '.join(values)}")


# Type default for a null in a required column ------------------------------------
def type_default(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, NUMERIC):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(b"").cast("binary")
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    if isinstance(dt, T.ArrayType):
        return F.array().cast(dt)
    return _null(dt)


def null_to_default(c: Column, dt: T.DataType) -> Column:
    return F.coalesce(c, type_default(dt))


# Extension point: caller conversions, as Column expressions ------------------------------
_REGISTRY: dict[tuple[str, str], object] = {}


def register_conversion(source_type: str, target_type: str, fn) -> None:
    """Register ``fn(Column) -> Column`` (or ``-> (value, error)``) for one
    (source type, column type) pair, named by Spark simple type strings such
    as ``"string"`` / ``"decimal(10,2)"``.  It takes precedence over the
    built-in rules; the expression stays JVM-side like every other one."""
    _REGISTRY[(source_type, target_type)] = fn


def unregister_conversion(source_type: str, target_type: str) -> None:
    _REGISTRY.pop((source_type, target_type), None)


# Dispatch on (source type, column type) ---------------------------------------------
def coerce_value(c: Column, src: T.DataType, col, opts, field: str | None = None) -> Conv:
    """Convert one field to one target column (``col`` is a ColumnSpec).

    Conversion runs only when the types differ; equal types pass untouched.
    Uncoercible values give an error (the unit is quarantined) or, with
    ``on_uncoercible='null'``, a plain NULL."""
    value, err = _coerce(c, src, col, opts, field or col.name)
    if col.enum_values is not None:
        v2, e2 = enum_check(value, col.enum_values, col.name)
        value, err = v2, F.coalesce(err, e2)
    if opts.on_uncoercible == "null":
        err = F.lit(None).cast("string")
    return value, err


def _coerce(c: Column, src: T.DataType, col, opts, field: str) -> Conv:
    dt = col.dtype
    custom = _REGISTRY.get((type_label(src), type_label(dt)))
    if custom is not None:
        out = custom(c)
        if isinstance(out, tuple):
            return out
        return out, failed(c, out, f"Cannot convert field '{field}' for column '{col.name}'")
    if isinstance(src, T.VariantType) and src != dt:
        return value_of_variant(c, col, opts, field)
    if col.uuid:
        return uuid_to_string(c)
    if src == dt:
        return c, F.lit(None).cast("string")
    msg = (f"Cannot convert field '{field}' of type {type_label(src)} "
           f"to {type_label(dt)} for column '{col.name}'")
    if isinstance(src, T.NullType):
        return _null(dt), F.lit(None).cast("string")
    if isinstance(dt, T.StringType):
        return to_text(c, src)
    if isinstance(dt, T.BinaryType):
        if isinstance(src, T.StringType):
            return binary_from_string(c, opts.binary_format)
        if isinstance(src, T.ArrayType) and isinstance(src.elementType, T.ByteType):
            return binary_from_bytes(c)
        if opts.binary_from == "text" and not isinstance(src, (T.ArrayType, T.StructType, T.MapType)):
            return binary_of_text(c)
        return binary_reject(c, src)
    if isinstance(src, (T.ArrayType, T.StructType, T.MapType)) and not isinstance(
            dt, (T.ArrayType, T.StructType, T.MapType)):
        # A collection into a scalar column
        return _null(dt), failed(c, _null(dt), msg)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(src, T.StringType):
            return flexible_timestamp(c, opts.timestamp_format, dt)
        return timestamp_from_value(c, src, dt)
    if isinstance(dt, T.DateType):
        if isinstance(src, T.StringType):
            return date_from_string(c, opts.date_format)
        if isinstance(src, INTEGRAL):
            return date_from_epoch_ms(c)
        value = c.try_cast("date")
        return value, failed(c, value, msg)
    if isinstance(dt, NUMERIC) and isinstance(src, T.StringType):
        return number_from_string(c, dt, msg)
    if isinstance(dt, T.BooleanType) and isinstance(src, NUMERIC):
        value = c != F.lit(0)
        return value, failed(c, value, msg)
    if isinstance(dt, T.BooleanType) and isinstance(src, T.StringType):
        value = F.trim(c).try_cast("boolean")
        return value, failed(c, value, msg)
    value = c.try_cast(dt)
    return value, failed(c, value, msg)
