"""Benchmark decontamination: which documents hold which test items.

Size-partitioned MinHash containment search. The items are partitioned by their number of
distinct five-word shingles (powers of two); each partition has its own sketch size: the k
smallest shingle hashes of an item, where k - 1 is the most shingles that a document which
contains the item at the threshold can lack. So at least one sketch hash of such an item is in
the document, however long the document is: nothing is lost up to ``MAX_SKETCH`` (above it, the
chance to miss is below (1 - threshold) ** MAX_SKETCH, 2e-25 at 0.8; ``max_sketch=None`` sets no
bound and makes the search exact at every length). Documents that hold a
sketch hash are then verified by exact shingle containment on the shingles' own text.

The document side is one scan that streams its shingle hashes past the sketch table; only hits
are shuffled, pre-aggregated per document and item. The sketches and the item shingles are
broadcast after a count (longs only for the sketches); larger benchmarks join by shuffle.

An item of one to four words has one shingle, the whole of it. Documents give shingles of those
lengths too, but only of the lengths that the items have, so a benchmark without such items costs
nothing. ``decontaminated`` does not look for them inside longer documents: a word or two are in
sound documents as well, and go only with documents that are that very text.

Defined cases: words are runs without ASCII white space; a document of one to four words has itself as
a shingle; texts without words (null, empty) hold and match nothing; items that
repeat (same id and text) count once; documents that share id and text give one row per item;
an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

SHINGLE = 5
THRESHOLD = 0.8
MAX_SKETCH = 36


def _with_short(long: Column, none: str, w: str, lengths: Sequence[int], shingle: str) -> Column:
    """The shingles ``long`` and those of ``lengths`` words of a longer text."""
    if not lengths:
        return long
    short = [F.expr(f"CASE WHEN size({w}) > {m} THEN transform(sequence(0, size({w}) - {m}), "
                    f"i -> {shingle.format(f"array_join(slice({w}, i + 1, {m}), ' ')")}) ELSE CAST(array() AS {none}) END")
             for m in lengths]
    return F.array_distinct(F.concat(long, *short))


def shingle_hashes(w: str = "_w", n: int = SHINGLE, lengths: Sequence[int] = ()) -> Column:
    """Distinct 64-bit hashes of the n-word shingles of the word list in column ``w``, and of those of
    the shorter ``lengths``."""
    args = ", ".join(f"{w}[i + {k}]" for k in range(n))
    long = F.expr(f"CASE WHEN size({w}) = 0 THEN CAST(array() AS array<bigint>) "
                  f"WHEN size({w}) < {n} THEN array(xxhash64(array_join({w}, ' '))) "
                  f"ELSE array_distinct(transform(sequence(0, size({w}) - {n}), i -> xxhash64({args}))) END")
    return _with_short(long, "array<bigint>", w, lengths, "xxhash64({})")


def shingle_texts(w: str = "_w", n: int = SHINGLE, lengths: Sequence[int] = ()) -> Column:
    """Distinct n-word shingles themselves, and those of the shorter ``lengths``."""
    long = F.expr(f"CASE WHEN size({w}) = 0 THEN CAST(array() AS array<string>) "
                  f"WHEN size({w}) < {n} THEN array(array_join({w}, ' ')) "
                  f"ELSE array_distinct(transform(sequence(0, size({w}) - {n}), i -> array_join(slice({w}, i + 1, {n}), ' '))) END")
    return _with_short(long, "array<string>", w, lengths, "{}")


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, item_key, n_item, shingle): one row per distinct shingle of each distinct item."""
    body = C.whole_text(text)
    return (items.select(F.col(item_id).alias("item_id"), C.text_key(body).alias("item_key"), C.words(body).alias("_w"))
            .dropDuplicates(["item_id", "item_key"])
            .withColumn("_s", shingle_texts()).where(F.size("_s") > 0)
            .select("item_id", "item_key", F.size("_s").cast("long").alias("n_item"), F.explode("_s").alias("shingle")))


def sketches(shingles: DataFrame, hashed: DataFrame, threshold: float = THRESHOLD, max_sketch: int | None = MAX_SKETCH) -> DataFrame:
    """(h, item_key): the sketch hashes of every item, as many as its size partition asks for."""
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n_item")))
    size = F.least(F.floor(F.lit(1 - threshold) * upper + 1e-9) + 1, F.lit(max_sketch or (1 << 31) - 1), F.col("n_item"))
    rank = F.row_number().over(Window.partitionBy("item_key").orderBy("h"))
    return (hashed.withColumn("size", size).withColumn("rank", rank).where("rank <= size")
            .select("h", "item_key").distinct())


def find_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id",
               text: str = "text", item_id: str = "item_id", item_text: str = "text", short_items: bool = True,
               max_sketch: int | None = MAX_SKETCH) -> DataFrame:
    """(doc_id, doc_key, item_id, n_shared, n_item, containment) for every document and item whose
    shingles are in the document at the threshold or more; ``short_items``: items below five words are
    looked for inside longer documents."""
    spark = docs.sparkSession
    size = F.size(C.words(C.whole_text(item_text)))
    lengths = ()
    if short_items:                                      # at most SHINGLE - 1 rows
        lengths = sorted(r[0] for r in items.select(size).where((size > 0) & (size < SHINGLE)).distinct().collect())
    shingles = C.cut(item_shingles(items, item_id, item_text))
    # the hash of a shingle's words in order, as shingle_hashes makes it on the document side
    hashed = (items.select(C.whole_text(item_text).alias("_t")).distinct()
              .select(C.text_key(F.col("_t")).alias("item_key"), C.words(F.col("_t")).alias("_w"))
              .withColumn("_h", shingle_hashes()).where(F.size("_h") > 0)
              .select("item_key", F.size("_h").alias("n_item"), F.explode("_h").alias("h")))
    sketch = C.small(sketches(shingles, hashed, threshold, max_sketch))
    body = C.whole_text(text)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), body.alias("_t"), C.text_key(body).alias("doc_key"))
    hits = (keyed.withColumn("_w", C.words(F.col("_t")))
            .select("doc_id", "doc_key", F.explode(shingle_hashes(lengths=lengths)).alias("h"))
            .join(sketch, "h").select("doc_id", "doc_key").distinct())
    found = C.small(hits.withColumnsRenamed({"doc_id": "f_id", "doc_key": "f_key"}))
    if not shingles.count():
        return spark.createDataFrame([], f"doc_id {dict(docs.dtypes)[doc_id]}, doc_key long, item_id {dict(items.dtypes)[item_id]}, "
                                         "n_shared long, n_item long, containment double")
    held = (keyed.join(found, (F.col("doc_key") == F.col("f_key")) & F.col("doc_id").eqNullSafe(F.col("f_id")), "left_semi")
            .dropDuplicates(["doc_id", "doc_key"])
            .withColumn("_w", C.words(F.col("_t")))
            .select("doc_id", "doc_key", F.explode(shingle_texts(lengths=lengths)).alias("shingle")))
    # at most 200,000 shingles of five words: tens of MB
    known = F.broadcast(shingles) if shingles.count() <= C.BROADCAST_ROWS else shingles
    need = F.ceil(F.lit(threshold) * F.col("n_item") - 1e-9)
    return (held.join(known, "shingle").groupBy("doc_id", "doc_key", "item_id", "item_key", "n_item")
            .agg(F.count("*").alias("n_shared")).where(F.col("n_shared") >= need)
            .select("doc_id", "doc_key", "item_id", "n_shared", "n_item",
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


def decontaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that hold no item, with their columns."""
    key = C.text_key(C.whole_text("text"))
    bad = C.small(find_items(docs, items, threshold, short_items=False).select(F.col("doc_id").alias("b_id"), F.col("doc_key").alias("b_key")).distinct())
    keyed = docs.select(C.row_of(docs), F.col("doc_id").alias("k_id"), key.alias("k_key"))
    return C.unpacked(keyed.join(bad, F.col("k_id").eqNullSafe(F.col("b_id")) & (F.col("k_key") == F.col("b_key")), "left_anti"), docs)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    items = C.read(spark, sf_dir, "benchmark").select("item_id", "text")
    return find_items(docs, items).drop("doc_key")


SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, md5(coalesce(text, '')) AS k FROM documents),
i AS (SELECT DISTINCT item_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, md5(coalesce(text, '')) AS k FROM benchmark),
ds AS (SELECT DISTINCT doc_id, k, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) END) AS s FROM d
  UNION SELECT doc_id, k, unnest(list_transform(range(1, len(w) - m + 2), lambda p: array_to_string(w[p:p + m - 1], ' '))) AS s
    FROM d JOIN (SELECT DISTINCT len(w) AS m FROM i WHERE len(w) BETWEEN 1 AND 4) ON len(w) > m),
bs AS (SELECT DISTINCT item_id, k, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda p: array_to_string(w[p:p + 4], ' ')) END) AS s FROM i),
q AS (SELECT item_id, k, count(*) AS n_item FROM bs GROUP BY ALL)
SELECT doc_id, bs.item_id, CAST(count(*) AS BIGINT) AS n_shared, CAST(n_item AS BIGINT) AS n_item, count(*) / n_item AS containment
FROM ds JOIN bs USING (s) JOIN q ON q.item_id IS NOT DISTINCT FROM bs.item_id AND q.k = bs.k
GROUP BY doc_id, ds.k, bs.item_id, bs.k, n_item HAVING count(*) * 10 >= 8 * n_item
"""

QUERIES = {"op10_decontamination": op10_decontamination}
ORACLES = {"op10_decontamination": SQL}
