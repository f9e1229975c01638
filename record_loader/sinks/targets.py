"""Sinks (K1-K3): the bulk insert of one conformed batch, and the route /
receipt tables.

Targets:
- ``JdbcTarget``: a relational table over JDBC.  Insert modes:
  ``single``  one write task and one JDBC batch (the batch is atomic);
  ``staged``  parallel append to a staging table, then one
              ``INSERT INTO target SELECT ... FROM staging`` in one transaction;
  ``parallel`` plain parallel append (auto-commit; not atomic).
- ``PathTarget``: files under a path (parquet / orc / json ...), appended
  with Spark's job commit protocol: one job per batch.
- ``TableTarget``: a catalog table (``insertInto``, columns in the table's order).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import ConfigError


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder for lineage cuts and intermediate tables: the cluster's
    ``spark.checkpoint.dir``.  Only a local session without one gets a fresh
    temporary folder; on a cluster every machine would have its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext          # classic sessions only
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    current = sc._jsc.sc().getCheckpointDir() if sc is not None else None
    if not base and current is not None and current.isDefined():
        base = os.path.dirname(current.get().rstrip("/"))
    if not base:
        if sc is None or not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ConfigError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="record-loader-")
        spark.conf.set("spark.checkpoint.dir", base)
    if current is not None and not current.isDefined():
        sc.setCheckpointDir(base)
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of :func:`shared_dir`."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


LOAD_BATCH = "load_batch"


@dataclass
class PathTarget:
    """Files under ``path``.  With ``idempotent`` every load that carries a
    token (a stream passes ``<load_name>-<batch_id>``) is written, in
    overwrite mode, to its own ``load_batch=<token>`` folder: replaying a
    micro-batch rewrites the same folder instead of appending twice."""

    path: str
    fmt: str = "parquet"
    partition_by: tuple = ()
    options: dict = field(default_factory=dict)
    idempotent: bool = False

    @property
    def url(self) -> str:
        return f"{self.fmt}:{self.path}"

    def append(self, df: DataFrame, opts=None, token: str | None = None) -> None:
        dest, mode = self.path, "append"
        if self.idempotent and token is not None:
            dest, mode = f"{self.path.rstrip('/')}/{LOAD_BATCH}={token}", "overwrite"
        w = df.write.mode(mode).format(self.fmt)
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        for k, v in self.options.items():
            w = w.option(k, v)
        w.save(dest)

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        r = spark.read.format(self.fmt)
        if schema is not None:
            r = r.schema(schema)
        df = r.load(self.path)
        return df.drop(LOAD_BATCH) if self.idempotent else df

    def stored_keys(self, spark: SparkSession, key, token: str | None = None) -> DataFrame | None:
        """The key columns of the stored rows (F3), but for those that the
        token's own load wrote; None before the first load."""
        try:
            df = spark.read.format(self.fmt).load(self.path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        if self.idempotent and token is not None and LOAD_BATCH in df.columns:
            df = df.where(F.col(LOAD_BATCH).cast("string") != token)
        return df.select(*[F.col(f"`{k}`") for k in key])


@dataclass
class TableTarget:
    name: str

    @property
    def url(self) -> str:
        return f"table:{self.name}"

    def append(self, df: DataFrame, opts=None, token: str | None = None) -> None:
        # insertInto is positional: put the columns in the table's own order
        cols = df.sparkSession.table(self.name).columns
        df.select(*cols).write.insertInto(self.name)

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        return spark.table(self.name)

    def stored_keys(self, spark: SparkSession, key, token: str | None = None) -> DataFrame:
        """The key columns of the stored rows."""
        return spark.table(self.name).select(*[F.col(f"`{k}`") for k in key])


@dataclass
class JdbcTarget:
    url_: str
    table: str
    properties: dict = field(default_factory=dict)
    staging_table: str | None = None
    execute_sql: object = None      # callable(list[str]) -> None, runs in one transaction

    @property
    def url(self) -> str:
        return self.url_

    def _writer(self, df: DataFrame, table: str, opts, batchsize: int | None = None,
                isolation: str | None = None):
        w = (df.write.format("jdbc").mode("append").option("url", self.url_)
             .option("dbtable", table))
        for k, v in self.properties.items():
            w = w.option(k, v)
        if batchsize:
            w = w.option("batchsize", str(batchsize))
        if isolation:
            w = w.option("isolationLevel", isolation)
        if opts is not None and opts.timeout_seconds:
            w = w.option("queryTimeout", str(opts.timeout_seconds))
        return w

    def check_exists(self, spark: SparkSession) -> None:
        """Fail (naming the table) when the target does not exist: Spark's
        JDBC append would otherwise create it."""
        r = (spark.read.format("jdbc").option("url", self.url_)
             .option("query", f"SELECT * FROM {self.table} WHERE 1=0"))
        for k, v in self.properties.items():
            r = r.option(k, v)
        try:
            r.load().schema
        except Exception as e:  # noqa: BLE001
            raise LookupError(f"Table not found: {self.table} ({e})") from e

    def append(self, df: DataFrame, opts=None, token: str | None = None) -> None:
        mode = opts.effective_mode if opts is not None else "single"
        self.check_exists(df.sparkSession)
        if mode == "single":
            # one task, one JDBC batch, one commit.  repartition(1) is a
            # shuffle, so everything upstream of it stays parallel.
            self._writer(df.repartition(1), self.table, opts, batchsize=2**31 - 1).save()
        elif mode == "parallel":
            self._writer(df, self.table, opts, isolation="NONE").save()
        elif mode == "staged":
            staging = self.staging_table or f"{self.table}_STAGE_{uuid.uuid4().hex[:8].upper()}"
            (self._writer(df, staging, opts).mode("overwrite").option("truncate", "true").save())
            cols = ", ".join(df.columns)
            run = self.execute_sql or jvm_sql_runner(df.sparkSession, self.url_, self.properties,
                                                     opts.timeout_seconds if opts else 0)
            try:
                run([f"INSERT INTO {self.table} ({cols}) SELECT {cols} FROM {staging}"])
            finally:
                if not self.staging_table:           # a caller's own table stays
                    run([f"DROP TABLE {staging}"])
        else:
            raise ValueError(mode)

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        r = spark.read.format("jdbc").option("url", self.url_).option("dbtable", self.table)
        for k, v in self.properties.items():
            r = r.option(k, v)
        return r.load()


def jvm_sql_runner(spark: SparkSession, url: str, properties: dict, timeout_s: int = 0):
    """Statements run on the driver through the JVM's ``DriverManager`` in
    one transaction (classic sessions).  Injectable: pass ``execute_sql`` to
    the target to use another client."""
    def run(statements):
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for k, v in properties.items():
            props.setProperty(k, str(v))
        conn = jvm.java.sql.DriverManager.getConnection(url, props)
        try:
            conn.setAutoCommit(False)
            st = conn.createStatement()
            if timeout_s:
                st.setQueryTimeout(int(timeout_s))
            for s in statements:
                st.executeUpdate(s)
            conn.commit()
        except Exception:
            conn.rollback()
            raise
        finally:
            conn.close()
    return run


def bulk_insert(df: DataFrame, target, opts=None, token: str | None = None) -> int | None:
    """K1/K2: append one conformed batch to ``target`` as one insert.
    ``token`` names the batch for targets that make replays idempotent.
    Returns the rows that the target says it holds of the batch, if it counts
    them itself (it may know the batch already and write nothing)."""
    if token is None:
        return target.append(df, opts)
    return target.append(df, opts, token=token)


#: Between the load name and the run in a folder's name.
RUN = "@run-"


def load_folder(path: str, load_name: str, run: str | None = None) -> str:
    """The folder of one load in a route or receipt table.  ``run`` tells
    loads of one name apart: a stream's query id, or a re-drive's units."""
    return f"{path.rstrip('/')}/load_name={load_name}{RUN + run if run else ''}"


def batch_folder(path: str, load_name: str, batch_id: int, run: str | None = None) -> str:
    """The folder of one batch in a route or receipt table."""
    return f"{load_folder(path, load_name, run)}/batch_id={batch_id}"


def named_loads(df: DataFrame) -> DataFrame:
    """A route or receipt table with load_name, run (null where there is none) and batch_id told apart."""
    folder = F.col("load_name").cast("string")
    return df.withColumns({"load_name": F.regexp_replace(folder, f"{RUN}.*$", ""), "batch_id": F.col("batch_id").cast("long"),
                           "run": F.when(folder.contains(RUN), F.regexp_extract(folder, f"{RUN}(.*)$", 1))})


def write_routes(units: DataFrame, path: str, load_name: str, batch_id: int, fmt: str = "parquet", run: str | None = None) -> None:
    """K3: the unit routes (success / retry / failure) of one batch, each
    relationship in its own folder.  The batch's folder is rewritten, so a
    replay leaves one route per unit."""
    (units.drop("load_name", "run", "batch_id").write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "static").partitionBy("route").save(batch_folder(path, load_name, batch_id, run)))


def read_routes(spark: SparkSession, path: str, route: str | None = None,
                fmt: str = "parquet") -> DataFrame:
    df = named_loads(spark.read.format(fmt).load(path))
    return df.where(F.col("route") == route) if route else df
