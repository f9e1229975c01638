"""Mixing sources to target weights by weighted fair queueing.

Every copy of a document gets a virtual finish time: the words of its source up to and with
that copy (in shuffled order, repeat after repeat) over the source's target. The copies of all
sources are then ranged by finish time and cut where the budget is used up; no copy starts after
its source's target is used up, so a source is over its target by less than one document.

Within a source the taken copies are a prefix of the shuffled order in every repeat, so the
whole decision is one small table: source -> last taken key of each repeat. No text is moved.

Running sums never see a whole source or the whole corpus in one task: keys fall into 4,096
ranges per source (sums of ranges, then a window inside a range), finish times into ranges of
about ``RANGE_ROWS`` copies, of which only the one that holds the cut is looked at row by row.

Defined cases: null text has size 0; null source is a source of its own, last in order;
rows that agree in doc_id, text and source stand together (taken or not as one); documents of
size 0 are never taken; an empty table gives no rows; other columns are carried untouched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
RANGE_ROWS = 100_000


def shuffle_key(doc_id: Column, text: Column) -> Column:
    """Place of a document in its source's shuffled order."""
    return F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(text)))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> also (rank, weight, target). Targets share the total by weight,
    stop at ``max_repeats`` times the source's size, and what is over is shared again: the level
    is found in one pass over the sources ordered by cap per weight."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = (sizes.withColumn("rank", F.row_number().over(by_name))
         .withColumn("weight", F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]),
                                            ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * max_repeats)
         .withColumn("full_at", F.col("cap") / F.col("weight")))
    order = Window.orderBy("full_at", "rank")
    every = Window.partitionBy()
    s = (s.withColumn("total", F.sum("source_size").over(every))
         .withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("left_weight", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("capped")) / F.col("left_weight"))
         .withColumn("found", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "rank", "level"))).over(every)))
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("found.level") * F.col("weight"), F.col("cap").cast("double")))
    return s.select("source", "source_size", "rank", "weight", target.alias("target"), "total")


def running(items: DataFrame) -> DataFrame:
    """Words of the source before and with each item, in key order."""
    items = items.withColumn("part", F.substring("key", 1, 3))
    parts = items.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("p_source"), F.col("part").alias("p_part"),
                         F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return (items.withColumn("inside", F.sum("size").over(inside))
            .join(parts, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("part") == F.col("p_part")))
            .select("source", "key", "size", (F.col("base") + F.col("inside")).alias("cum")))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS,
                source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` and (mix_size, mix_source_size, mix_target, mix_copies): how often
    the mix takes each document."""
    body = C.whole_text(text)
    sized = docs.select(C.row_of(docs), F.col(source).cast("string").alias("source"), C.n_words(body).alias("size"),
                        shuffle_key(F.col(doc_id), body).alias("key"))
    items = C.cut(sized.groupBy("source", "key").agg(F.sum("size").alias("size")))
    targets = C.cut(source_targets(items.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats))
    t = targets.select(F.col("source").alias("t_source"), "source_size", "rank", "target", "total")
    ran = running(items.where("size > 0"))
    copies = C.cut(ran.join(t, F.col("source").eqNullSafe(F.col("t_source"))).where("target > 0")
                   .withColumn("again", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
                   .withColumn("finish", (F.col("again") * F.col("source_size") + F.col("cum")).cast("double") / F.col("target"))
                   # no copy starts after its source's target is used up
                   .where((F.col("again") * F.col("source_size") + F.col("cum") - F.col("size")) <= F.col("target"))
                   .select("rank", "key", "size", "again", "finish", "total"))
    taken = taken_prefix(copies)
    last = (taken.groupBy("rank", "again").agg(F.max("key").alias("last"))
            .groupBy("rank").agg(F.map_from_entries(F.collect_list(F.struct("again", "last"))).alias("lasts")))
    # one row per source, counted: texts do not meet it by a shuffle on a few sources
    table = C.small(targets.join(last, "rank", "left").select(F.col("source").alias("t_source"), "source_size", "target", "lasts"))
    used = sum((F.coalesce((F.col("key") <= F.col("lasts")[F.lit(i)]).cast("int"), F.lit(0)) for i in range(max_repeats)), F.lit(0))
    joined = sized.join(table, F.col("source").eqNullSafe(F.col("t_source")), "left")
    return C.unpacked(joined, docs, mix_size=F.col("size"), mix_source_size=F.col("source_size"), mix_target=F.col("target"),
                      mix_copies=F.when(F.col("size") > 0, used).otherwise(0))


def taken_prefix(copies: DataFrame) -> DataFrame:
    """The copies, ordered by (finish, rank, again, key), whose running words stay within the total."""
    shape = copies.agg(F.count("*").alias("n"), F.max("finish").alias("most"), F.first("total", True).alias("total")).first()
    ranges = max(1, -(-shape["n"] // RANGE_ROWS)) * 16
    width = (shape["most"] or 1.0) / ranges
    ranged = copies.withColumn("slot", F.floor(F.col("finish") / F.lit(width)))
    slots = (ranged.groupBy("slot").agg(F.sum("size").alias("words"))
             .withColumn("upto", F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))))
    over = slots.where(F.col("upto") > F.lit(shape["total"] or 0)).orderBy("slot").first()  # one row
    if over is None:
        return copies
    base = over["upto"] - over["words"]
    order = Window.orderBy("finish", "rank", "again", "key").rowsBetween(Window.unboundedPreceding, 0)
    edge = (ranged.where(F.col("slot") == over["slot"]).withColumn("upto", F.sum("size").over(order) + F.lit(base))
            .where(F.col("upto") <= F.lit(shape["total"])))
    return ranged.where(F.col("slot") < over["slot"]).select(*copies.columns).unionByName(edge.select(*copies.columns))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: documents of the input, each as often as it is taken."""
    return (mix_sources(docs.select(C.row_of(docs), "doc_id", "source", "text"), **options).where("mix_copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select("row.*"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"))


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))) AS key
    FROM documents),
items AS (SELECT source, key, CAST(sum(size) AS BIGINT) AS size FROM sized GROUP BY ALL),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM items GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rnk FROM s),
w AS (SELECT *, [5, 2, 1][(rnk - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM r),
o AS (SELECT *, cap / weight AS full_at FROM w),
l AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
        (CAST(sum(source_size) OVER () AS BIGINT)
         - CAST(coalesce(sum(cap) OVER (ORDER BY full_at, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
        / CAST(sum(weight) OVER (ORDER BY full_at, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
    FROM o),
f AS (SELECT arg_min(level, (full_at, rnk)) AS level FROM l WHERE level <= full_at),
t AS (SELECT source, source_size, rnk, total, least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM f) * weight, CAST(cap AS DOUBLE))) AS target FROM l),
ran AS (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum FROM items),
copies AS (
    SELECT rnk, key, size, again, total, CAST(again * source_size + cum AS DOUBLE) / target AS finish
    FROM ran JOIN t ON ran.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1, 2]) AS again)
    WHERE size > 0 AND target > 0 AND again * source_size + cum - size <= target),
kept AS (
    SELECT rnk, key FROM (SELECT *, sum(size) OVER (ORDER BY finish, rnk, again, key ROWS UNBOUNDED PRECEDING) AS upto FROM copies)
    WHERE upto <= total)
SELECT doc_id, CAST(sized.size AS BIGINT) AS size, source_size, target,
    CAST(sized.size * (SELECT count(*) FROM kept WHERE kept.rnk = t.rnk AND kept.key = sized.key) AS BIGINT) AS taken
FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source
"""

QUERIES = {"op6_mixing": op6_mixing}
ORACLES = {"op6_mixing": SQL}
