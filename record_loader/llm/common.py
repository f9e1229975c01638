"""Helpers shared by the training-data operators: words, keys, shared folder, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words of the operators' contracts.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of at most three longs: a broadcast of so many stays near 16 MB.
BROADCAST_ROWS = 200_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(col: str | Column = "text") -> Column:
    """The text; null is the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """Words of a text in order (maximal runs without ASCII white space)."""
    core = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE))


def n_words(text: Column) -> Column:
    """Number of words of a text."""
    core = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(core == "", F.lit(0)).otherwise(F.size(F.split(core, SPACE))).cast("long")


def row_of(df: DataFrame) -> Column:
    """All columns of a frame as one struct ``row``, so that no name of theirs meets one of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def unpacked(df: DataFrame, row: DataFrame, **more: Column) -> DataFrame:
    """The columns of ``row`` back from the struct, and ``more``, which replace those of their names."""
    return df.select(*[F.col("row").getField(c).alias(c) for c in row.columns if c not in more],
                     *[c.alias(k) for k, c in more.items()])


def text_key(text: Column) -> Column:
    """64-bit hash of a whole text; with doc_id it tells rows apart."""
    return F.xxhash64(text)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a
    local session gets a folder of its own; a cluster must name one."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            sc.setCheckpointDir(found)
        return found.rstrip("/")
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return sc._jsc.sc().getCheckpointDir().get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    return shared_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """The frame with its lineage cut: narrow rows, checkpointed in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a Parquet table in the shared folder and read back (wide rows)."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table that this run wrote and nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A checkpointed frame of fixed-width rows, to be broadcast if it holds at most ``rows``
    (counted); otherwise joins with it shuffle."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= rows else df
