"""SimHash near-duplicates by covering locality-sensitive hashing.

1. One pass over the texts makes a 64-bit fingerprint per document: every three-word shingle's XXH64
   votes on each bit, and a bit is set if over half of the shingles set it.
2. Equal fingerprints are one node (counted map-side), so a group of copies of any size goes on as
   one row.
3. Covering family for radius r: every bit gets a nonzero vector of r + 1 bits, and every nonzero v
   gives the mask of the bits whose vector has an odd number of ones in common with v. The vectors of
   any r bits span at most r dimensions, so some v is orthogonal to all of them and its mask hides
   them: two fingerprints within the radius agree under at least one of the 2 ** (r + 1) - 1 masks.
   Nothing is left to chance.
4. A bucket is a (mask, masked fingerprint); one aggregation, map-side first, gives its members'
   number, smallest and largest. A bucket of two is checked right there. Members of larger ones meet
   and are compared pair by pair in the task, which gives one edge per member. A bucket of more than
   ``BUCKET`` members is split by a second covering family over the bits that its mask hides (of those
   about half are hidden again), and so once more. The third family hides at most eight bits, so no
   bucket there can hold more than 256 different fingerprints: large groups are split exactly, and
   nothing is capped.
5. Components of the edges are the near-duplicate groups.

Shuffles: fingerprints (narrow), 15 rows per different fingerprint, members of buckets with three or
more. Fingerprints that hold more than one in ``HOT_SHARE`` documents (so at most ``HOT_SHARE`` of
them) get their component by a broadcast, the others by a join.

Defined cases: only A-Z are lower-cased; fewer than three words are one shingle; null, empty and
blank texts have fingerprint zero, linked like any other; null doc_id is a row like others and never
a component's name, unless all its documents have none; repeated rows are kept; a very long text
needs memory in proportion to itself and a block of its hashes; ties (a bit set in exactly half) give
zero; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .jaccard import components

#: Fixed values of the contract.
SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64

BUCKET = 256
LAST_BITS = 8
HOT_SHARE = 1000
BLOCK_HASHES = 1 << 16
_SPACE = np.frombuffer(b" ", np.uint8)[0]


# ---- fingerprints ----

def shingle_hashes(text: str) -> np.ndarray:
    """XXH64 of every three-word shingle of a text, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == _SPACE)
    n = max(len(words) - SHINGLE + 1, 1)
    starts = np.concatenate([[0], gaps + 1])[:n].tolist()
    stops = np.append(gaps, len(joined))[-n:].tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits (bit 63 first) that over half of the hashes set."""
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), BLOCK_HASHES):
        bits = np.unpackbits(hashes[k:k + BLOCK_HASHES].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, fp)."""
    for batch in batches:
        fps = [fingerprint(shingle_hashes(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp) per document; ``fp`` is the fingerprint as a signed long."""
    body = docs.select(F.col(doc_id).cast("long").alias("id"), C.whole_text(text).alias("text"))
    return body.mapInArrow(_fingerprints, "id long, fp long")


# ---- covering masks ----

def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bits such that any ``radius`` of them are all outside at least one mask."""
    size = 2 ** (radius + 1) - 1
    vector = {b: k % size + 1 for k, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2) for v in range(1, size + 1)]


def mask_levels(radius: int = RADIUS) -> list[list[tuple[int, int, int]]]:
    """Levels of (table of the level above, own table, mask): below a table the masks also hold its
    mask, and cover the bits that it hides. Levels end where a mask hides at most ``LAST_BITS``."""
    levels, above = [], [(0, 0)]
    while not levels or max(BITS - m.bit_count() for _, m in above) > LAST_BITS:
        rows = []
        for parent, mask in above:
            hidden = [b for b in range(BITS) if not mask >> b & 1]
            rows += [(parent, len(rows) + k, mask | more) for k, more in enumerate(covering_masks(hidden, radius))]
        levels.append(rows)
        above = [(t, m) for _, t, m in rows]
    return levels


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


# ---- links ----

def _edges(radius: int):
    """Rows (tab, part, fp), sorted by the first two: in each bucket, one edge from a member to the
    smallest one it is connected with. Buckets hold few members by construction."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64),) * 3

        def linked(tab, part, fp):
            n = len(fp)
            same = np.ones(n + 1, bool)
            same[1:n] = (tab[1:] != tab[:-1]) | (part[1:] != part[:-1])
            group = np.cumsum(same[:n]) if n else np.zeros(0, np.int64)
            a, b = [], []
            for step in range(1, n):  # members that stand `step` apart in one bucket
                at = np.flatnonzero(group[step:] == group[:-step])
                if not len(at):
                    break
                near = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= radius]
                a.append(fp[near])
                b.append(fp[near + step])
            if not a:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            return _forest(np.concatenate(a), np.concatenate(b))

        def rows_of(x):
            return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1])], names=["a", "b"])

        for batch in batches:
            cols = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) if len(cols[0]) else np.zeros(0, bool)
            cut = len(last) - int(np.count_nonzero(last))
            yield rows_of(linked(*(c[:cut] for c in cols)))
            held = tuple(c[cut:] for c in cols)
        yield rows_of(linked(*held))

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges to each node's smallest connected one in place of all the given ones."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = code[:len(a)], code[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def linked_fingerprints(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b): edges between different fingerprints (``fp``) within the radius, enough of them to
    connect all that are linked."""
    spark = nodes.sparkSession
    levels = mask_levels(radius)
    rows = nodes.select(F.lit(0).alias("tab"), "fp")
    out = []
    for depth, level in enumerate(levels):
        masks = spark.createDataFrame([(p, t, _signed(m)) for p, t, m in level], "up int, own int, mask long")  # at most 15 ** 3 rows
        dealt = (rows.join(F.broadcast(masks), F.col("tab") == F.col("up"))
                 .select(F.col("own").alias("tab"), F.col("fp").bitwiseAND(F.col("mask")).alias("part"), "fp"))
        found = C.cut(dealt.groupBy("tab", "part")
                      .agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.bit_xor(F.xxhash64("fp")).alias("all"))
                      .where("n > 1"))
        out.append(found.where(F.col("n") == 2).where(F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= radius)
                   .select(F.col("lo").alias("a"), F.col("hi").alias("b")))
        # of buckets with the same members (texts that agree under many masks) one is enough
        more = found.where("n > 2").groupBy("n", "lo", "hi", "all").agg(F.min(F.struct("tab", "part")).alias("at")).select("n", "at.tab", "at.part")
        last = depth == len(levels) - 1
        few = more if last else more.where(F.col("n") <= bucket)
        # by a hash of the keys: Spark drops a repartition by the join's own keys, and adaptive
        # execution then splits buckets (skewed partitions, local reads under a late broadcast)
        out.append(dealt.join(few.select("tab", "part"), ["tab", "part"])
                   .repartition(F.xxhash64("tab", "part")).sortWithinPartitions("tab", "part")
                   .mapInArrow(_edges(radius), "a long, b long"))
        if last:
            break
        # two large buckets may hold the same members under different masks: their smaller buckets must too
        many = found.where(F.col("n") > bucket).select("tab", "part")
        if many.isEmpty():
            break
        rows = C.cut(dealt.join(many, ["tab", "part"]).select("tab", "fp"))
    edges = out[0]
    for e in out[1:]:
        edges = edges.unionByName(e)
    return edges.distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(id, fp, component_id), one row per document: its fingerprint and the smallest doc_id that
    links of at most ``radius`` differing bits reach."""
    fps = C.cut(fingerprints(docs, doc_id, text))
    nodes = C.cut(fps.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("rows")))
    label = components(C.cut(linked_fingerprints(nodes, radius, bucket))).withColumnsRenamed({"node": "fp"})
    of = nodes.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = of.groupBy("label").agg(F.min("first").alias("component_id"))
    known = C.cut(of.join(least, "label").select("fp", "component_id", "rows"))
    total = F.broadcast(nodes.agg(F.sum("rows").alias("total")))  # one row
    shared = known.join(total).withColumn("hot", F.col("rows") * HOT_SHARE > F.col("total"))
    hot = F.broadcast(shared.where("hot").select("fp", F.col("component_id").alias("hot_id"), F.lit(True).alias("hot")))  # under HOT_SHARE rows
    marked = fps.join(hot, "fp", "left")
    rest = marked.where("hot IS NULL").select("id", "fp").join(known.select("fp", "component_id"), "fp").select("id", "fp", "component_id")
    return marked.where("hot").select("id", "fp", F.col("hot_id").alias("component_id")).unionByName(rest)


def hex_of(fp: str | Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), hex_of("fp").alias("fingerprint"), "component_id")


QUERIES = {"op11_simhash": op11_simhash}
#: XXH64 has no SQL form; the query is tested against brute force.
ORACLES: dict[str, str] = {}
