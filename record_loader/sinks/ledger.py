"""Targets with a commit ledger (K2, W1): files are staged first and become visible by one ledger entry.

A load is two writes: its rows into a folder of their own, then one ledger file that names the folder.
Readers follow the ledger, so rows that were staged but not committed are never seen, and a load that
was committed is not done again: a commit is known by its token (a stream passes its load name, query
id and batch id). Between the two writes a driver may die at any time; the replay stages anew, and
:meth:`LedgerTarget.recover` removes what was left.

The join of data and ledger is a semi-join on partition columns, so Spark prunes the folders that the
ledger does not name (dynamic partition pruning) and no folder name reaches the driver.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMIT, TRY, BUCKET, VERSION, TABLE = "load_commit", "load_try", "load_bucket", "load_version", "load_table"
#: names of the ledger's own columns, which a target's columns may not use
OWN = (COMMIT, TRY, BUCKET, VERSION)


def _found(read):
    """What ``read`` returns, or None if its path is not there yet; any other failure raises."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@dataclass
class LedgerTarget:
    """Parquet files under ``path``, appended exactly once per token."""

    path: str

    @property
    def url(self) -> str:
        return f"ledger:{self.path}"

    @property
    def _data(self) -> str:
        return f"{self.path.rstrip('/')}/data"

    @property
    def _ledger(self) -> str:
        return f"{self.path.rstrip('/')}/ledger"

    def committed(self, spark: SparkSession, token: str) -> int | None:
        """Rows of the load that was committed under the token; None if none was."""
        entry = _found(lambda: spark.read.schema(f"{TRY} string, rows long").json(f"{self._ledger}/{COMMIT}={_name(token)}"))
        rows = entry.collect() if entry is not None else []          # one row
        return rows[0]["rows"] if rows else None

    def append(self, df: DataFrame, opts=None, token: str | None = None) -> int:
        """Stages and commits the rows; a token that is committed already is left as it is. Returns the
        rows that the token's load holds."""
        spark, token = df.sparkSession, token or uuid.uuid4().hex
        known = self.committed(spark, token)
        if known is not None:
            return known
        attempt, rows = self.stage(df, token)
        self.commit(spark, token, attempt, rows)
        return rows

    def stage(self, df: DataFrame, token: str) -> tuple[str, int]:
        """First write: the rows in a folder that nothing names yet."""
        _check_names(df)
        attempt, seen = f"t-{uuid.uuid4().hex}", Observation()
        (df.observe(seen, F.count(F.lit(1)).alias("rows")).write
         .parquet(f"{self._data}/{COMMIT}={_name(token)}/{TRY}={attempt}"))
        return attempt, int(seen.get["rows"])

    def commit(self, spark: SparkSession, token: str, attempt: str, rows: int) -> None:
        """Second write: one ledger file of one row, which appears by a rename."""
        (spark.createDataFrame([(attempt, rows)], f"{TRY} string, rows long").coalesce(1)
         .write.mode("overwrite").json(f"{self._ledger}/{COMMIT}={_name(token)}"))

    def entries(self, spark: SparkSession) -> DataFrame | None:
        """The ledger: (load_try, rows, load_commit) of every committed load."""
        return _found(lambda: spark.read.schema(f"{TRY} string, rows long, {COMMIT} string").json(self._ledger))

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        """The rows of committed loads. Before the first load there is only the given schema."""
        ledger, data = self.entries(spark), _found(lambda: spark.read.parquet(self._data))
        if ledger is None or data is None:
            if schema is None:
                raise LookupError(f"nothing was loaded into {self.path} yet")
            return spark.createDataFrame([], schema)
        return data.join(ledger.select(COMMIT, TRY), [COMMIT, TRY], "left_semi").drop(COMMIT, TRY)

    def stored_keys(self, spark: SparkSession, key, token: str | None = None) -> DataFrame | None:
        """The key columns of the stored rows (F3), but for those of the token's load; None before the first load."""
        ledger, data = self.entries(spark), _found(lambda: spark.read.parquet(self._data))
        if ledger is None or data is None:
            return None
        others = ledger.where(F.col(COMMIT) != _name(token)) if token else ledger
        return data.join(others.select(COMMIT, TRY), [COMMIT, TRY], "left_semi").select(*[F.col(f"`{k}`") for k in key])

    def recover(self, spark: SparkSession, older_than_seconds: float = 86_400) -> int:
        """Removes staged folders that no ledger entry names and that are older than any running load
        can be; returns how many. The names of the folders (not rows) reach the driver."""
        kept = {(r[COMMIT], r[TRY]) for r in (self.entries(spark).collect() if self.entries(spark) is not None else [])}
        return _remove(spark, f"{self._data}/{COMMIT}=*/{TRY}=*", lambda names: (names[-2].split("=", 1)[1], names[-1].split("=", 1)[1]) not in kept,
                       older_than_seconds)


@dataclass
class MergeTarget(LedgerTarget):
    """A keyed table: rows replace stored rows of the same key (W1), and only the buckets that hold a
    key of the load are rewritten.

    Keys are dealt over ``buckets`` by hash. A load reads the stored rows of its own buckets, keeps per key
    the row with the greatest ``version`` (the later load wins a tie; without ``version`` the later load wins),
    writes these buckets into a folder of its own, and commits by the next ledger version, which names for
    every bucket the folder that holds it: one row per bucket, so the ledger that the driver reads is bounded by
    ``buckets``. Files of other buckets stay as they are. One writer at a time: a load that finds another one
    committed since it began fails (it does not lock, so writers must not commit at the same moment)."""

    key: tuple = ()
    version: tuple = ()
    buckets: int = 64

    def __post_init__(self):
        if not self.key:
            raise ValueError("a merge needs a key")

    @property
    def url(self) -> str:
        return f"merge:{self.path}"

    def _state(self, spark: SparkSession) -> tuple[int, list]:
        """The latest ledger version and its rows (bucket, folder, rows, commit), one per bucket."""
        ledger = _found(lambda: spark.read.schema(f"{BUCKET} int, {TRY} string, rows long, {COMMIT} string, {VERSION} long").json(self._ledger))
        if ledger is None:
            return 0, []
        last = ledger.agg(F.max(VERSION)).first()[0]
        return (0, []) if last is None else (last, ledger.where(F.col(VERSION) == last).collect())

    def committed(self, spark: SparkSession, token: str) -> int | None:
        ledger = _found(lambda: spark.read.schema(f"rows long, {COMMIT} string").json(self._ledger))
        if ledger is None:
            return None
        found = ledger.where(F.col(COMMIT) == token).agg(F.count(F.lit(1)), F.sum("rows")).first()
        return int(found[1]) if found[0] else None

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets)).cast("int")

    def _stored(self, spark: SparkSession, rows: list) -> DataFrame | None:
        """The stored rows of ledger rows, with their bucket."""
        if not rows:
            return None
        named = spark.createDataFrame([(r[BUCKET], r[TRY]) for r in rows], f"{BUCKET} int, {TRY} string")   # at most one per bucket
        return spark.read.parquet(self._data).join(F.broadcast(named), [TRY, BUCKET], "left_semi").drop(TRY)

    def append(self, df: DataFrame, opts=None, token: str | None = None) -> int:
        """Merges the rows; returns the rows that the rewritten buckets hold."""
        _check_names(df)
        spark, token = df.sparkSession, token or uuid.uuid4().hex
        known = self.committed(spark, token)
        if known is not None:
            return known
        last, rows = self._state(spark)
        new = df.withColumn(BUCKET, self._bucket())
        touched = {r[0] for r in new.select(BUCKET).distinct().collect()}                  # at most one per bucket
        if not touched:
            return 0
        stored = self._stored(spark, [r for r in rows if r[BUCKET] in touched])
        both = new.withColumn("load_new", F.lit(1))
        if stored is not None:
            both = both.unionByName(stored.withColumn("load_new", F.lit(0)), allowMissingColumns=True)
        cols = [f"`{c}`" for c in both.columns if c not in (*self.key, BUCKET, "load_new")]
        # rows of one load that agree in key and version: any fixed rule will do
        order = F.struct(*[F.col(f"`{v}`") for v in self.version], F.col("load_new"), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]))
        merged = (both.groupBy(BUCKET, *self.key).agg(F.max_by(F.struct(*cols), order).alias("load_row"))
                  .select(BUCKET, *self.key, "load_row.*"))
        attempt = f"t-{uuid.uuid4().hex}"
        merged.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self._data}/{TRY}={attempt}")
        made = {r[0]: r[1] for r in spark.read.parquet(f"{self._data}/{TRY}={attempt}").groupBy(BUCKET).count().collect()}
        if self._state(spark)[0] != last:
            raise RuntimeError(f"another load was committed into {self.path} meanwhile")
        entries = [(r[BUCKET], r[TRY], r["rows"], r[COMMIT]) for r in rows if r[BUCKET] not in touched]
        entries += [(b, attempt, n, token) for b, n in sorted(made.items())]
        (spark.createDataFrame(entries, f"{BUCKET} int, {TRY} string, rows long, {COMMIT} string").coalesce(1)
         .write.mode("overwrite").json(f"{self._ledger}/{VERSION}={last + 1}"))    # over what a dead driver left of it
        return sum(made.values())

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        stored = self._stored(spark, self._state(spark)[1])
        if stored is None:
            if schema is None:
                raise LookupError(f"nothing was loaded into {self.path} yet")
            return spark.createDataFrame([], schema)
        return stored.drop(BUCKET)

    def stored_keys(self, spark: SparkSession, key, token: str | None = None) -> DataFrame | None:
        """None: stored rows of the same key are replaced, not refused."""
        return None

    def recover(self, spark: SparkSession, older_than_seconds: float = 86_400) -> int:
        """Removes folders that the latest ledger version does not name."""
        kept = {r[TRY] for r in self._state(spark)[1]}
        return _remove(spark, f"{self._data}/{TRY}=*", lambda names: names[-1].split("=", 1)[1] not in kept, older_than_seconds)


@dataclass
class FanOutTarget(LedgerTarget):
    """Several tables of one layout under ``path`` (K4): one job writes the rows of all of them, dealt by their
    ``load_table`` column, and one ledger entry of a row per table commits them together, so either every table
    holds its part of a load or none does.

    Rows are rebalanced by table before the write: small tables take few files, and a table that holds a third of
    all rows is split over many tasks (by Spark's adaptive execution, from measured sizes)."""

    @property
    def url(self) -> str:
        return f"tables:{self.path}"

    def committed(self, spark: SparkSession, token: str) -> int | None:
        entry = _found(lambda: spark.read.schema(f"{TRY} string, rows long").json(f"{self._ledger}/{COMMIT}={_name(token)}"))
        if entry is None:
            return None
        found = entry.agg(F.count(F.lit(1)), F.sum("rows")).first()
        return int(found[1]) if found[0] else None

    def stage(self, df: DataFrame, token: str) -> tuple[str, int]:
        _check_names(df.drop(TABLE))
        attempt, seen = f"t-{uuid.uuid4().hex}", Observation()
        named = df.withColumn(TABLE, F.concat(F.lit("t-"), TABLE))             # never a name that reads as a number or date
        (named.observe(seen, F.count(F.lit(1)).alias("rows")).hint("rebalance", F.col(TABLE)).write.partitionBy(TABLE)
         .parquet(self._folder(token, attempt)))
        return attempt, int(seen.get["rows"])

    def _folder(self, token: str, attempt: str) -> str:
        return f"{self._data}/{COMMIT}={_name(token)}/{TRY}={attempt}"

    def commit(self, spark: SparkSession, token: str, attempt: str, rows: int) -> None:
        """One ledger file with a row per table (one without a table if there are no rows)."""
        per_table = f"{TRY} string, rows long, {TABLE} string"
        entries = (spark.read.parquet(self._folder(token, attempt)).groupBy(TABLE).agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(attempt).alias(TRY), "rows", TABLE) if rows else spark.createDataFrame([(attempt, 0, None)], per_table))
        entries.coalesce(1).write.mode("overwrite").json(f"{self._ledger}/{COMMIT}={_name(token)}")

    def entries(self, spark: SparkSession) -> DataFrame | None:
        return _found(lambda: spark.read.schema(f"{TRY} string, rows long, {TABLE} string, {COMMIT} string").json(self._ledger))

    def read(self, spark: SparkSession, schema=None, table: str | None = None) -> DataFrame:
        """The rows of one table, or those of all with their ``load_table``."""
        ledger, data = self.entries(spark), _found(lambda: spark.read.parquet(self._data))
        if ledger is None or data is None:
            if schema is None:
                raise LookupError(f"nothing was loaded into {self.path} yet")
            return spark.createDataFrame([], schema)
        rows = data.join(ledger.select(COMMIT, TRY).distinct(), [COMMIT, TRY], "left_semi").drop(COMMIT, TRY)
        if table is not None:
            return rows.where(F.col(TABLE) == f"t-{table}").drop(TABLE)
        return rows.withColumn(TABLE, F.substring(TABLE, 3, 2**31 - 1))

    def stored_keys(self, spark: SparkSession, key, token: str | None = None) -> DataFrame | None:
        """None: a load into many tables checks no keys."""
        return None


def _name(token: str) -> str:
    """A token as a folder name (never one that reads as a number or date)."""
    return "c-" + "".join(c if c.isalnum() and c.isascii() or c in "-_." else f"~{ord(c):x}~" for c in token)


def _check_names(df: DataFrame) -> None:
    taken = [c for c in df.columns if c in (*OWN, "load_new", "load_row")]
    if taken:
        raise ValueError(f"columns {taken} are names of the ledger")


def _remove(spark: SparkSession, pattern: str, drop, older_than_seconds: float) -> int:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = 0
    for s in fs.globStatus(path) or []:
        names = s.getPath().toString().rsplit("/", 2)
        if drop(names) and time.time() * 1000 - s.getModificationTime() >= older_than_seconds * 1000:
            fs.delete(s.getPath(), True)
            n += 1
    return n
