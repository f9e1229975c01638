"""Target description and load options.

``TargetSpec`` is the only thing that lives on the driver: an ordered list of
target columns (name, Spark type, required flag, optional enum domain) plus the
table's constraints.  Everything else is a DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .functions.names import normalize_name

TRANSLATIONS = ("REMOVE_UNDERSCORE", "PATTERN", "NONE")
UNMATCHED_FIELD = ("ignore", "fail")
UNMATCHED_COLUMN = ("ignore", "warn", "fail")
BINARY_FORMATS = ("utf-8", "hex", "base64")
INSERT_MODES = ("single", "staged", "parallel")


class ConfigError(ValueError):
    """Raised on the driver, before any job, for an invalid option set."""


_SIMPLE_TYPES = {
    "string": T.StringType(), "varchar": T.StringType(), "int": T.IntegerType(),
    "integer": T.IntegerType(), "bigint": T.LongType(), "long": T.LongType(),
    "smallint": T.ShortType(), "short": T.ShortType(), "tinyint": T.ByteType(),
    "byte": T.ByteType(), "double": T.DoubleType(), "float": T.FloatType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(), "binary": T.BinaryType(),
}


def _as_type(dtype: T.DataType | str) -> T.DataType:
    """A Spark type from a DDL name; primitives need no session."""
    if isinstance(dtype, T.DataType):
        return dtype
    simple = _SIMPLE_TYPES.get(dtype.strip().lower())
    return simple if simple is not None else T._parse_datatype_string(dtype)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: T.DataType
    required: bool = False
    enum_values: tuple[str, ...] | None = None
    uuid: bool = False          # text that must be a UUID (declared type ``uuid``)

    @staticmethod
    def of(name: str, dtype: T.DataType | str, required: bool = False,
           enum_values=None) -> "ColumnSpec":
        ev = tuple(enum_values) if enum_values is not None else None
        uuid = isinstance(dtype, str) and dtype.strip().lower() == "uuid"
        return ColumnSpec(name, T.StringType() if uuid else _as_type(dtype), required, ev, uuid)


@dataclass(frozen=True)
class TargetSpec:
    """Columns of one target table, in table order.

    ``checks`` are SQL boolean expressions over target column names (a row
    breaking one rejects its whole batch, like a CHECK constraint);
    ``key`` is the primary / ordering key; it drives ``replacing_merge``.
    With ``unique_key`` a key held twice inside one batch rejects the batch
    before the insert.  That check shuffles every row by key, so it is
    opt-in: a relational target enforces its own primary key at insert time.
    """

    name: str
    columns: tuple[ColumnSpec, ...]
    key: tuple[str, ...] = ()
    checks: tuple[str, ...] = ()
    unique_key: bool = False

    @staticmethod
    def of(name: str, columns, key=(), checks=(), unique_key=False) -> "TargetSpec":
        cols = tuple(c if isinstance(c, ColumnSpec) else ColumnSpec.of(*c) for c in columns)
        spec = TargetSpec(name, cols, tuple(key), tuple(checks), unique_key)
        names = [c.name for c in cols]
        if len(set(n.upper() for n in names)) != len(names):
            raise ConfigError(f"duplicate column names in target {name}: {names}")
        return spec

    @staticmethod
    def from_schema(name: str, schema: T.StructType, required=(), key=(), checks=(),
                    enums=None) -> "TargetSpec":
        """Spec from a Spark schema.  Required-ness comes from the caller:
        JDBC and most catalogs report every column nullable."""
        enums = enums or {}
        req = {r.upper() for r in required}
        cols = [ColumnSpec(f.name, f.dataType, f.name.upper() in req or not f.nullable,
                           tuple(enums[f.name]) if f.name in enums else None)
                for f in schema.fields]
        return TargetSpec.of(name, cols, key, checks)

    @staticmethod
    def from_ddl(name: str, ddl: str, **kw) -> "TargetSpec":
        return TargetSpec.from_schema(name, T._parse_datatype_string(ddl), **kw)

    @staticmethod
    def from_table(spark: SparkSession, table: str, **kw) -> "TargetSpec":
        """Read the target's columns once per load from a catalog table."""
        return TargetSpec.from_schema(table, spark.table(table).schema, **kw)

    @staticmethod
    def from_jdbc(spark: SparkSession, url: str, table: str, properties=None, **kw) -> "TargetSpec":
        """Read the target's columns over JDBC (schema only: ``WHERE 1=0``)."""
        reader = spark.read.format("jdbc").option("url", url).option(
            "query", f"SELECT * FROM {table} WHERE 1=0")
        for k, v in (properties or {}).items():
            reader = reader.option(k, v)
        return TargetSpec.from_schema(table, reader.load().schema, **kw)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.required]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.columns])

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)

    def lookup(self, translation: str = "REMOVE_UNDERSCORE", pattern: str | None = None
               ) -> dict[str, ColumnSpec]:
        """Normalised column name -> column."""
        return {normalize_name(c.name, translation, pattern): c for c in self.columns}


@dataclass(frozen=True)
class LoadOptions:
    """Options of one load.  ``validate()`` runs on the driver before any job.

    ``max_units``: input units (files / source ids) per batch; 0 = all queued.
    ``auto_commit``: True selects the non-atomic ``parallel`` insert; it cannot
    be combined with rollback-on-failure and needs ``max_units`` = 0.
    ``timeout_ms``: statement timeout in milliseconds; handed to JDBC as whole
    seconds (floor); 0 = none.
    """

    translation: str = "REMOVE_UNDERSCORE"
    pattern: str | None = None
    unmatched_field: str = "ignore"
    unmatched_column: str = "fail"
    on_uncoercible: str = "quarantine"     # or 'null'
    on_null_required: str = "keep"         # 'keep' | 'fail' | 'default'
    binary_format: str = "utf-8"
    binary_from: str = "reject"            # or 'text' (binary of the value's text)
    date_format: str = "yyyy-MM-dd"
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    max_units: int = 1000
    auto_commit: bool | None = False
    rollback_on_failure: bool = False
    timeout_ms: int = 0
    mode: str = "single"
    snapshot: str = "cache"                # or 'rescan': what the insert pass reads
    spread_partitions: int = 0             # see operators.conform.spread_records
    record_path: str | None = None         # P10: load the records at this path of each record

    def with_(self, **kw) -> "LoadOptions":
        return replace(self, **kw)

    @property
    def timeout_seconds(self) -> int:
        return max(0, int(self.timeout_ms) // 1000)

    @property
    def effective_mode(self) -> str:
        return "parallel" if self.auto_commit else self.mode

    def validate(self) -> "LoadOptions":
        problems = []
        if self.translation not in TRANSLATIONS:
            problems.append(f"translation must be one of {TRANSLATIONS}")
        if self.translation == "PATTERN" and not self.pattern:
            problems.append("translation PATTERN needs a pattern")
        if self.unmatched_field not in UNMATCHED_FIELD:
            problems.append(f"unmatched_field must be one of {UNMATCHED_FIELD}")
        if self.unmatched_column not in UNMATCHED_COLUMN:
            problems.append(f"unmatched_column must be one of {UNMATCHED_COLUMN}")
        if self.on_uncoercible not in ("quarantine", "null"):
            problems.append("on_uncoercible must be 'quarantine' or 'null'")
        if self.on_null_required not in ("keep", "fail", "default"):
            problems.append("on_null_required must be 'keep', 'fail' or 'default'")
        if self.binary_format not in BINARY_FORMATS:
            problems.append(f"binary_format must be one of {BINARY_FORMATS}")
        if self.binary_from not in ("reject", "text"):
            problems.append("binary_from must be 'reject' or 'text'")
        if self.mode not in INSERT_MODES:
            problems.append(f"mode must be one of {INSERT_MODES}")
        if self.snapshot not in ("cache", "rescan"):
            problems.append("snapshot must be 'cache' or 'rescan'")
        if self.spread_partitions < 0:
            problems.append("spread_partitions must be >= 0")
        if self.max_units < 0:
            problems.append("max_units must be >= 0")
        if self.timeout_ms < 0:
            problems.append("timeout_ms must be >= 0")
        if self.auto_commit:
            if self.rollback_on_failure:
                problems.append("auto_commit cannot be combined with rollback_on_failure")
            if self.max_units != 0:
                problems.append("auto_commit requires max_units = 0")
        if problems:
            raise ConfigError("; ".join(problems))
        return self
