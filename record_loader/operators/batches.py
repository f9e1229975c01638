"""Batch planning over units (B1-B3), receipts (A1-A3) and the replacing
merge (W1).

Batch planning runs over the *unit* table (one row per input file / source
id), never over records, and numbers units without gathering them in one
task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.targets import shared_dir


# B1 -----------------------------------------------------------------------------------
def plan_batches(units: DataFrame, max_units: int, order_cols=("arrival", "source_id"),
                 partition_cols=("target",), out: str = "batch_id",
                 num_partitions: int | None = None) -> DataFrame:
    """Number batches of up to ``max_units`` units in arrival order, per
    target (0 = every queued unit in batch 0).  ``max_units`` counts units,
    not rows: a unit of a million records is still one unit.

    The numbering is distributed: units are range-partitioned on the
    arrival order, each range counts its units per target, prefix sums over
    a target's ranges (at most ``num_partitions`` rows each) give every
    range its offset, and a window *inside* each range adds the local
    position.  No task ever holds the whole unit table, and nothing reaches
    the driver, however many targets there are."""
    order = [c for c in order_cols if c in units.columns]
    parts = [c for c in partition_cols if c in units.columns]
    if max_units <= 0:
        return units.withColumn(out, F.lit(0).cast("long"))
    spark = units.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    shared_dir(spark)
    # one row per unit; checkpointed, because a range's number must not change between its two uses
    ranged = units.repartitionByRange(n, *parts, *order).withColumn("__p", F.spark_partition_id()).checkpoint()
    counts = ranged.groupBy("__p", *parts).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*parts).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range and target; units without a target are a target of their own
    offsets = counts.select(F.col("__p").alias("__q"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(parts)],
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(parts)], F.col("__p") == F.col("__q"))
    w = Window.partitionBy("__p", *parts).orderBy(*order)
    idx = F.col("__off") + F.row_number().over(w) - 1
    out_df = ranged.join(offsets, same).withColumn(out, F.floor(idx / F.lit(max_units)).cast("long"))
    return out_df.select(*units.columns, out)


# B2 -----------------------------------------------------------------------------------
def coalesce_units(dfs) -> DataFrame:
    """Union units whose records carry different fields, by name; a field
    missing from a unit is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# B3 -----------------------------------------------------------------------------------
def take_batch(units: DataFrame, n: int, order_cols=("arrival", "source_id")) -> DataFrame:
    """The first ``n`` queued units in arrival order (one trigger's take)."""
    order = [c for c in order_cols if c in units.columns]
    return units.orderBy(*order).limit(n) if n > 0 else units


# A1-A3 ---------------------------------------------------------------------------------
def rows_inserted(loaded: DataFrame, by=("batch_id",)) -> DataFrame:
    """Rows bound to the insert, per batch (partial aggregation)."""
    return loaded.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_inserted"))


def batches_executed(units: DataFrame, by=("target",), batch: str = "batch_id",
                     unit: str = "source_id") -> DataFrame:
    """Batches executed and units loaded, per target."""
    return units.groupBy(*[c for c in by if c in units.columns]).agg(
        F.countDistinct(batch).alias("batches_executed"),
        F.count(unit).alias("units"))


def load_receipts(routed: DataFrame, destination: str) -> DataFrame:
    """One receipt per unit of a load's routed units (``source_id``,
    ``batch_id``, ``route``, ``rows``, ``error``): those and the destination."""
    return routed.select("source_id", "batch_id", F.lit(destination).alias("destination"), "route",
                         F.col("rows").cast("long").alias("rows"), "error")


# W1 ------------------------------------------------------------------------------------
def replacing_merge(df: DataFrame, key, version) -> DataFrame:
    """Rows sharing ``key`` collapse to the one with the greatest ``version``
    (a list of columns, compared left to right).

    ``max_by`` over a struct is a declarative aggregate: Spark combines it
    map-side before the shuffle, so a key holding a third of all rows is
    reduced in every task first and only one row per key and task moves."""
    key = [key] if isinstance(key, str) else list(key)
    version = [version] if isinstance(version, str) else list(version)
    cols = df.columns
    rest = [c for c in cols if c not in key]
    ver = F.struct(*[F.col(v) for v in version])
    merged = df.groupBy(*key).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ver).alias("__r"))
    return merged.select(*[F.col(c) if c in key else F.col(f"__r.`{c}`").alias(c) for c in cols])
