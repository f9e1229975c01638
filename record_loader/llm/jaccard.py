"""N-gram Jaccard join: near-duplicate documents by MinHash banding.

1. One pass over the texts makes, per document, a 128-bit text hash, the number of distinct
   five-word shingles and the MinHash bands. Documents of equal text are one class, with one
   representative; only representatives go on.
2. Bands and rows are chosen for a target recall at the threshold (:func:`choose_bands`). Band
   hashes are shuffled; buckets with one text fall away, and of buckets with the same members
   (texts that agree in many bands) one is kept.
3. Members of the kept buckets get their full shingle sets, and every pair of a bucket is verified
   on them. A pair that shares several buckets counts in the first one. A bucket is dealt out as
   pairs of blocks of about ``BLOCK_TEXTS`` texts or ``BLOCK_SHINGLES`` shingles, so a task holds two
   blocks however large the bucket; pairs are counted there and never leave as rows: each text
   gives its number of links and one edge to the smallest text it is connected with in the block.
4. Links are summed; components of the edges (labels spread along edges, then jump to the label of
   their label, until nothing changes) are the near-duplicate classes.

Links are between different texts; copies share their representative's number of links.

Defined cases: words are runs without ASCII white space; a text of one to four words has one
shingle, the whole of it; texts without words link with nothing, and are one class if equal (null
text is empty); null doc_id is last in order, so a class id is null only if all its documents have
none; repeated rows are copies; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .rolling import Rolling, U, chunks, mix, text_bytes

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99999
MAX_HASHES = 128
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 2_000_000
CHUNK_BYTES = 1_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, so the fewest false candidates, for which enough bands
    for the recall at the threshold need no more than ``most`` hashes."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(2, 33):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= most:
            best = bands, rows
    return best


BANDS, ROWS = choose_bands()
_RNG = np.random.default_rng(5)
_ODD = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * U(2) + U(1)
_FLIP = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)
_STEP = _RNG.integers(1, 2**63, SHINGLE + ROWS, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def shingle_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of several texts in order, and where each text's end."""
    n = len(offsets) - 1
    word, border = ~_SPACE[data], np.zeros(len(data) + 1, bool)
    border[offsets] = True
    out_of = np.ones(len(data) + 2, bool)  # no word character at i - 1
    out_of[1:-1] = ~word
    starts = np.flatnonzero(word & (out_of[:-2] | border[:-1]))
    stops = np.flatnonzero(word & (out_of[2:] | border[1:])) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    words = mix(Rolling(data).pieces(starts, stops) + (stops - starts).astype(np.uint64))
    count = np.bincount(doc, minlength=n)
    total = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):
        m = len(words) - k
        if m > 0:
            total[:m] += words[k:] * _STEP[k]
    first = np.cumsum(count) - count
    whole = np.arange(len(words)) + SHINGLE <= (first + count)[doc]
    out, owner = mix(total[whole]), doc[whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        extra = np.array([sum((int(words[first[d] + k]) * int(_STEP[k]) for k in range(count[d])), int(count[d])) % 2**64 for d in short], np.uint64)
        out, owner = np.concatenate([out, mix(extra)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, np.cumsum(np.bincount(owner, minlength=n))


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and their ends."""
    values, ends = shingle_hashes(data, offsets)
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.cumsum(np.bincount(owner[fresh], minlength=len(sizes)))


def _signatures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, key, text) -> (id, key, n, bands)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        sizes, bands = [], []
        for lo, hi in chunks(offsets, CHUNK_BYTES):
            part = offsets[lo:hi + 1] - offsets[lo]
            values, ends = _sets(data[offsets[lo]:offsets[hi]], part)
            n = np.diff(ends, prepend=0)
            some = np.flatnonzero(n)
            got = np.zeros((hi - lo, BANDS), np.uint64)
            if len(some):
                starts = (ends - n)[some]
                for b in range(BANDS):
                    total = np.full(len(some), b + 1, np.uint64)
                    for r in range(ROWS):
                        j = b * ROWS + r
                        total += np.minimum.reduceat((values ^ _FLIP[j]) * _ODD[j], starts) * _STEP[SHINGLE + r]
                    got[some, b] = mix(total)
            sizes.append(n)
            bands.append(got)
        if not sizes:
            continue
        n = np.concatenate(sizes)
        flat = pa.array(np.concatenate(bands).view(np.int64).ravel())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(np.arange(0, (len(n) + 1) * BANDS, BANDS, dtype=np.int32)), flat)], names=["id", "key", "n", "bands"])


def _full_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> (key, grams): the set as 8 bytes per shingle."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        out = []
        for lo, hi in chunks(offsets, CHUNK_BYTES):
            values, ends = _sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            starts = np.concatenate([[0], ends[:-1]])
            out += [values[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["key", "grams"])


def _verify(sets: list[np.ndarray], shared: list[np.ndarray], here: int, sides: np.ndarray, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of a block pair: links of each text counted here, and the smallest text connected with it.
    ``shared``: the buckets of each text, sorted; a pair counts here if ``here`` is its first."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1] if m else np.zeros(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(codes.max() + 1 if len(codes) else 1, np.int32)
    links, label = np.zeros(m, np.int64), np.arange(m)

    def top(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    # of pairs in one block only the bucket's diagonal block pair counts; across blocks, one side each
    for i in range(m - 1):
        mine = codes[starts[i]:starts[i] + sizes[i]]
        rest = slice(i + 1, m)
        near = np.flatnonzero(((sides[rest] != sides[i]) if cross else np.ones(m - i - 1, bool))
                              & (sizes[rest] >= THRESHOLD * sizes[i]) & (sizes[i] >= THRESHOLD * sizes[rest])) + i + 1
        if not len(near):
            continue
        mark[mine] = 1
        if len(near) * 4 < m - i - 1:
            both = np.array([mark[codes[starts[j]:starts[j] + sizes[j]]].sum() for j in near])
        else:
            both = np.add.reduceat(mark[codes[starts[i + 1]:]], starts[rest] - starts[i + 1])[near - i - 1]
        mark[mine] = 0
        # shared / (a + b - shared) >= threshold, in whole numbers of the union
        for j in near[both >= THRESHOLD * (sizes[i] + sizes[near] - both) - 1e-9]:
            common = np.intersect1d(shared[i], shared[j], assume_unique=True)
            if common[0] == here:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(int(j))
                label[max(a, b)] = min(a, b)
    return links, np.array([top(i) for i in range(m)], np.int64)


PAIR_SCHEMA = "key binary, linked binary, links long"


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, left, right, side, key, buckets, grams), sorted by the first three: one group
    after the other, held only while it lasts."""
    held: list[tuple] = []
    group = None
    out: list[tuple[bytes, bytes, int]] = []

    def done() -> None:
        seen: dict[bytes, tuple] = {r[1]: r for r in held}  # repeated rows of one text
        rows = [seen[k] for k in sorted(seen)]
        if len(rows) > 1:
            links, label = _verify([np.frombuffer(r[3], np.uint64) for r in rows], [r[2] for r in rows], group[0],
                                   np.array([r[0] for r in rows]), group[1] != group[2])
            out.extend((rows[i][1], rows[label[i]][1], int(links[i])) for i in np.flatnonzero(links))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
                                           pa.array([r[2] for r in rows], pa.int64())], names=["key", "linked", "links"])

    for batch in batches:
        bucket, left, right, side, key, buckets, grams = (batch.column(i) for i in range(7))
        groups = list(zip(bucket.to_pylist(), left.to_pylist(), right.to_pylist(), strict=True))
        sides, flat, at = side.to_pylist(), buckets.values.to_numpy(), buckets.offsets.to_numpy()
        for i, g in enumerate(groups):
            if g != group:
                if held:
                    done()
                held, group = [], g
            held.append((sides[i], key[i].as_py(), np.sort(flat[at[i]:at[i + 1]]), grams[i].as_py()))
        if len(out) > 10_000:
            yield batch_of(out)
            out.clear()
    if held:
        done()
    yield batch_of(out)


def text_hash(text: Column) -> Column:
    """128 bits that stand for the text."""
    return F.unhex(F.md5(text))


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, n, bands) per document, stored (it is read several times)."""
    body = C.whole_text(text)
    made = docs.select(F.col(doc_id).cast("long").alias("id"), text_hash(body).alias("key"), body.alias("text"))
    return C.written(made.mapInArrow(_signatures, "id long, key binary, n long, bands array<bigint>"), "signatures")


def candidate_buckets(reps: DataFrame) -> DataFrame:
    """(key, rep, buckets array<struct<bucket, blocks>>) of texts that share a bucket with another."""
    rows = (reps.where("n > 0").select("key", "rep", "n", F.posexplode("bands").alias("band", "h"))
            .select("key", "rep", "n", F.xxhash64("band", "h").alias("bucket")))
    shared = (rows.groupBy("bucket").agg(F.count("*").alias("texts"), F.sum("n").alias("grams"),
                                         F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64(F.lit("second"), "key")).alias("y"))
              .where("texts > 1"))
    # of buckets with the same members one is enough
    kept = shared.groupBy("texts", "x", "y").agg(F.min("bucket").alias("bucket"), F.first("grams").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("grams") / BLOCK_SHINGLES)).cast("int")
    return (rows.join(kept.select("bucket", blocks.alias("blocks")), "bucket")
            .groupBy("key", "rep").agg(F.collect_list(F.struct("bucket", "blocks")).alias("buckets")))  # at most BANDS


def linked_texts(docs: DataFrame, reps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, linked, links): per text and block its verified links and a text connected with it."""
    near = candidate_buckets(reps)
    body = C.whole_text(text)
    keyed = docs.select(F.col(doc_id).cast("long").alias("id"), text_hash(body).alias("key"), body.alias("text"))
    one = keyed.join(near.select("key", F.col("rep").alias("id_of")), "key").where(F.col("id").eqNullSafe(F.col("id_of"))).select("key", "text")
    sets = one.mapInArrow(_full_sets, "key binary, grams binary")
    own = F.when(F.col("b.blocks") == 1, 0).otherwise(F.pmod(F.xxhash64("key", F.lit("block")), F.col("b.blocks").cast("long"))).cast("int")
    dealt = (sets.join(near, "key").withColumn("all", F.transform("buckets", lambda b: b["bucket"]))
             .withColumn("b", F.explode("buckets")).withColumn("side", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("b.blocks") - 1)))
             .select(F.col("b.bucket").alias("bucket"), F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"),
                     "side", "key", F.col("all").alias("buckets"), "grams"))
    return (dealt.repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right")
            .mapInArrow(_pairs, PAIR_SCHEMA))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the edges (a, b): the smallest node of each component."""
    both = C.cut(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = C.cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = C.cut(labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        jumped = C.cut(spread.join(spread.select(F.col("node").alias("label"), F.col("label").alias("far")), "label")
                       .select("node", "old", F.least("label", "far").alias("label")))
        labels = jumped.select("node", "label")
        if jumped.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, key, class_id, class_key, copy_of, n_links, n_shingles), one row per document. ``class_id``
    is the smallest doc_id of the near-duplicate class, ``copy_of`` that of the equal texts."""
    sigs = signatures(docs, doc_id, text)
    reps = C.written(sigs.groupBy("key").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "texts")
    linked = C.cut(linked_texts(docs, reps, doc_id, text))
    links = linked.groupBy("key").agg(F.sum("links").alias("n_links"))
    edges = linked.where(F.col("key") != F.col("linked")).select(F.col("key").alias("a"), F.col("linked").alias("b"))
    label = components(edges).withColumnsRenamed({"node": "key"})
    of = reps.select("key", "rep", "n").join(label, "key", "left").join(links, "key", "left").withColumn("label", F.coalesce("label", "key"))
    first = (of.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("first"))
             .select("label", F.col("first.rep").alias("class_id"), F.col("first.key").alias("class_key")))
    known = of.join(first, "label").select("key", "class_id", "class_key", F.col("rep").alias("copy_of"),
                                           F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("n").alias("n_shingles"))
    return sigs.select("id", "key").join(known, "key")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one of each near-duplicate class: the one with the smallest doc_id."""
    found = near_duplicates(docs)
    first = (found.where((F.col("key") == F.col("class_key")) & F.col("id").eqNullSafe(F.col("class_id")))
             .groupBy("id", "key").agg(F.count("*").alias("rows")).withColumnsRenamed({"id": "w_id", "key": "w_key"}))
    first = C.cut(first)
    keyed = docs.select(C.row_of(docs), F.col("doc_id").alias("k_id"), text_hash(C.whole_text("text")).alias("k_key"))
    same = (F.col("k_key") == F.col("w_key")) & F.col("k_id").eqNullSafe(F.col("w_id"))
    kept = keyed.join(first.where("rows = 1"), same)
    again = first.where("rows > 1")
    if not again.isEmpty():  # rows that share doc_id and text
        kept = kept.unionByName(keyed.join(again, same).dropDuplicates(["w_id", "w_key"]))
    return C.unpacked(kept, docs)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "class_id", "n_links", "copy_of", "n_shingles")


QUERIES = {"op2_ngram_jaccard": op2_ngram_jaccard}
ORACLES: dict[str, str] = {}
