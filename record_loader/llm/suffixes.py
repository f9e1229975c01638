"""Suffix-array dedup: removes every byte covered by a ``LENGTH``-byte string that also starts earlier
in the corpus (smaller doc_id, or earlier in the same document), judged on the input.

Sorting every suffix of the corpus is not needed to find them. A string of LENGTH bytes has
LENGTH - LEAD + 1 places where LEAD bytes start; its *anchor* is the one with the smallest hash (the
leftmost of equals). Equal strings have equal anchors, so only suffixes at anchors (about one byte
in forty) and the strings around them are compared:

1. One pass over the texts lists the anchors: hash of the leading bytes, the run of strings that
   share the anchor, and a hash of all the bytes of that run.
2. Anchors are partitioned by leading bytes; those whose leading bytes occur once are done.
   Of anchors with the same whole run, all but the earliest repeat every string of the run.
3. Where one lead has different runs (the ends of repeated passages), the earliest anchor of each
   run goes on as a suffix with its bytes. Sampled splitters range-partition these suffixes by
   leading bytes, document and place; each partition is sorted by itself and its strings are
   compared lead by lead. A lead that may go on in the next partition (the first and last of each)
   is compared across the boundary: its strings go out in blocks, blocks whose shared bytes no
   other has are dropped, and the strings of the rest meet by hash, where the earliest is kept.
   So a lead with any number of suffixes is spread over as many partitions as it fills.
4. The repeated strings of each document, as ranges of places, are joined to its text and cut out.

Strings are told apart by 64 bits beside their lead's 64. Shuffled rows are fixed-width but for
step 3's suffixes (at most 2 * LENGTH bytes) and two shuffles of the texts.

Defined cases: null text is empty; texts shorter than LENGTH stay whole; null doc_id comes first;
documents of one doc_id are ordered by the hash of their texts; rows that share both are one
document and get the same result; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .rolling import Rolling, U, chunks, mix, text_bytes

LENGTH = 100
LEAD = 24
WINDOW = LENGTH - LEAD + 1
CHUNK_BYTES = 200_000


def _least(g: np.ndarray) -> np.ndarray:
    """Smallest of every WINDOW consecutive values."""
    size = 1
    while size * 2 <= WINDOW:
        g = np.minimum(g[:-size], g[size:])
        size *= 2
    rest = WINDOW - size
    return np.minimum(g[:-rest], g[rest:]) if rest else g


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of several texts: (text, start, count, off, lead, run): strings start .. start + count - 1 (in
    the text) have their anchor off bytes behind start; hashes of the lead and of the whole run."""
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if len(data) < LENGTH:
        return none
    rolling = Rolling(data)
    g = mix(rolling.grams(LEAD))
    least = _least(g)
    sizes = np.diff(offsets)
    ok = np.arange(len(least)) + LENGTH <= np.repeat(offsets[1:], sizes)[:len(least)]
    fresh = np.ones(len(least), bool)  # the anchor is another than one place before
    fresh[1:] = (least[1:] < least[:-1]) | (g[:len(least) - 1] == least[:-1]) | ~ok[:-1]
    starts = np.flatnonzero(fresh & ok)
    if not len(starts):
        return none
    # a run ends before the next fresh place or the first string that leaves the text
    text = np.searchsorted(offsets, starts, "right") - 1
    last = offsets[text + 1] - LENGTH + 1
    stops = np.minimum(np.append(starts[1:], len(data)), last)
    off = np.zeros(len(starts), np.int64)
    for lo in range(0, len(starts), 20_000):
        some = starts[lo:lo + 20_000]
        off[lo:lo + 20_000] = (g[some[:, None] + np.arange(WINDOW)] == least[some][:, None]).argmax(1)
    count = stops - starts
    run = mix(rolling.pieces(starts, stops + LENGTH - 1) + (count * 128 + off).astype(np.uint64))
    return text, starts - offsets[text], count, off, least[starts], run


def _anchor_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(did, th, text) -> (did, th, place, lead, run); place packs start, count and off."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for lo, hi in chunks(offsets, CHUNK_BYTES):
            text, start, count, off, lead, run = anchors(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            at = pa.array(text + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(start * 16384 + count * 128 + off),
                 pa.array(lead.view(np.int64)), pa.array(run.view(np.int64))], names=["did", "th", "place", "lead", "run"])


def _suffix_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(did, th, text, places) -> (did, th, start, n, off, first, bytes): the runs' bytes; first: its lead."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        places = batch.column(3)
        flat, at = places.values.to_numpy(), places.offsets.to_numpy()
        flat = flat[at[0]:at[-1]]
        text = np.repeat(np.arange(len(places)), np.diff(at))
        start, count, off = flat >> 14, (flat >> 7) & 127, flat & 127
        raw = data.tobytes()
        begin = offsets[text] + start
        body = [raw[a:b] for a, b in zip(begin.tolist(), (begin + count + LENGTH - 1).tolist(), strict=True)]
        first = [x[o:o + LEAD] for x, o in zip(body, off.tolist(), strict=True)]
        take = pa.array(text)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(start), pa.array(count), pa.array(off),
                                          pa.array(first, pa.binary()), pa.array(body, pa.binary())], names=["did", "th", "start", "n", "off", "first", "bytes"])


#: Strings of a border lead go out in blocks of so many places of the anchor.
BLOCK = 8

#: border: up to BLOCK strings whose lead may go on in another partition, with the hash of the bytes
#: that all strings of such a block share (x), of the lead (y), and their own (null for those that are
#: repeated as it is); else a range of repeated strings
COMPARED = "border boolean, did long, th long, start long, n long, x long, y long, strings array<bigint>"


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition of suffixes, sorted by lead, document and place."""
    held: list[pa.Table] = []
    opening: bytes | None = None

    def rows(t: pa.Table, border: bool, row: np.ndarray, start: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray, strings: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        take = pa.array(row)
        did, th = (t.column(name).combine_chunks().take(take) for name in ("did", "th"))
        ends = np.concatenate([[0], np.cumsum(n if border else np.zeros(len(row), np.int64))]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(row), border)), did, th, pa.array(t.column("start").to_numpy()[row] + start), pa.array(n), pa.array(x.view(np.int64)),
             pa.array(y.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(strings.view(np.int64), mask=known))],
            names=["border", "did", "th", "start", "n", "x", "y", "strings"])

    def compared(t: pa.Table, border: bool) -> Iterator[pa.RecordBatch]:
        """Strings that stand earlier in the same rows, as ranges; of a border lead also the blocks
        with a string's first place, which another partition may hold earlier."""
        data, offsets = text_bytes(t.column("bytes").combine_chunks())
        rolling, n = Rolling(data), t.column("n").to_numpy()
        row = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        begin = offsets[:-1][row] + k
        x = mix(rolling.pieces(begin, begin + LENGTH))
        again = pd.Series(x).duplicated().to_numpy()  # rows stand in order, so the first is the earliest
        if border and len(row):
            off = t.column("off").to_numpy()
            block = (off[row] - k) // BLOCK           # by the anchor's place in the string
            edge = np.ones(len(row), bool)
            edge[1:] = (block[1:] != block[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(edge)
            size = np.diff(np.append(first, len(row)))
            new = np.add.reduceat((~again).astype(np.int64), first) > 0
            whole = np.repeat(new, size)
            strings, known = x[whole], again[whole]
            first, size = first[new], size[new]
            at = offsets[:-1][row[first]] + off[row[first]] - block[first] * BLOCK  # shared by the block: from its smallest place on
            core = mix(rolling.pieces(at, at + LENGTH - BLOCK + 1) + block[first].astype(np.uint64))
            leads, ends = text_bytes(t.column("first").combine_chunks())
            lead = mix(Rolling(leads).pieces(ends[:-1], ends[1:]) + U(7))
            yield rows(t, True, row[first], k[first], size, core, lead[row[first]], strings, known)
        edge = np.ones(len(row) + 1, bool)
        edge[1:-1] = (again[1:] != again[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(edge)
        size, first = np.diff(first), first[:-1]
        some = again[first] if len(first) else np.zeros(0, bool)
        first, size = first[some], size[some]
        zero = np.zeros(len(first), np.uint64)
        yield rows(t, False, row[first], k[first], size, zero, zero, zero[:0], again[:0])

    for batch in batches:
        if not len(batch):
            continue
        t = pa.Table.from_batches([batch])
        leads = t.column("first").to_pylist()
        opening = leads[0] if opening is None else opening
        # from the last lead of what has come on, rows may still follow
        last = next(j for j in range(len(leads) - 1, -1, -1) if j == 0 or leads[j - 1] != leads[-1])
        goes_on = bool(held) and held[-1].column("first")[-1].as_py() == leads[0]
        if goes_on and last == 0:
            held.append(t)
            continue
        done = pa.concat_tables([*held, t.slice(0, last)])
        if len(done):
            first = done.column("first")
            n = next((j for j in range(len(done)) if first[j].as_py() != opening), len(done)) if first[0].as_py() == opening else 0
            if n:
                yield from compared(done.slice(0, n), True)
            if n < len(done):
                yield from compared(done.slice(n), False)
        held = [t.slice(last)]
    if held:
        yield from compared(pa.concat_tables(held), True)


def _cut_out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(did, text, places, ranges) -> (did, n_bytes, n_removed, n_spans, kept_sha256)."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        raw = data.tobytes()
        whole, edges = batch.column(2), batch.column(3)
        removed, spans, digests = [], [], []
        for i in range(len(batch)):
            a, b = int(offsets[i]), int(offsets[i + 1])
            got = [(p >> 14, (p >> 7) & 127) for p in whole[i].as_py() or ()] + [(e // 128, e % 128) for e in edges[i].as_py() or ()]
            kept, at, gone, runs = hashlib.sha256(), 0, 0, 0
            end = -1
            for start, n in sorted(got):
                stop = start + n + LENGTH - 1
                if start > end:  # not joined to the run before
                    if end >= 0:
                        at = end
                    kept.update(raw[a + at:a + start])
                    runs += 1
                    gone += stop - start
                    end = stop
                elif stop > end:
                    gone += stop - end
                    end = stop
            kept.update(raw[a + max(end, 0):b])
            removed.append(gone)
            spans.append(runs)
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                                         names=["did", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Of (did, th, text): (did, th, whole, ends): per document the runs that repeat as a whole, and
    those of leads with different runs; arrays of packed places."""
    anchored = docs.mapInArrow(_anchor_rows, "did long, th long, place long, lead long, run long")
    # counted map-side first, then a plain join that Spark splits where a lead is very common
    often = C.written(anchored.groupBy("lead").agg(F.count("*").alias("anchors")).where("anchors > 1").select("lead"), "leads")
    shared = C.written(anchored.join(often, "lead"), "anchors")
    here = F.struct("did", "th", "place")
    runs = shared.groupBy("lead", "run").agg(F.min(here).alias("origin"))
    kinds = runs.groupBy("lead").agg((F.count("*") > 1).alias("differ"))
    known = runs.join(kinds, "lead")
    judged = (shared.join(known, ["lead", "run"]).withColumn("again", F.col("origin") < here).where("again OR differ")
              .select("did", "th", "place", "again"))
    return C.written(judged.groupBy("did", "th").agg(F.collect_set(F.expr("CASE WHEN again THEN place END")).alias("whole"),
                                                     F.collect_set(F.expr("CASE WHEN NOT again THEN place END")).alias("ends")), "runs")


def repeated_ends(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """(did, th, start, n): ranges of repeated strings among the runs in ``ends``."""
    # rows that share did and th are one document: its suffixes go out once, or they would repeat each other;
    # both sides by the same plain keys, so that the texts are shuffled once
    keys = ["th", "known", "number"]
    number = [F.col("did").isNotNull().alias("known"), F.coalesce("did", F.lit(0)).alias("number")]
    ends = runs.where(F.size("ends") > 0).select("th", *number, "ends")
    once = docs.select("did", "th", *number, "text").groupBy(*keys).agg(F.first("did").alias("did"), F.first("text").alias("text"))
    suffixes = once.join(ends, keys).select("did", "th", "text", "ends").mapInArrow(
        _suffix_rows, "did long, th long, start long, n long, off long, first binary, bytes binary")
    order = ["first", "did", "th", "start"]
    found = C.cut(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_compared, COMPARED))
    blocks = found.where("border")
    # a block whose shared bytes no other has holds no repeated string
    like = blocks.groupBy("x", "y").agg(F.count("*").alias("blocks")).where("blocks > 1").select("x", "y")
    new = F.expr("filter(transform(strings, (s, i) -> struct(s AS string, i AS k)), x -> x.string IS NOT NULL)")
    strings = (blocks.join(like, ["x", "y"]).select("did", "th", "start", "y", F.explode(new).alias("s"))
               .select("did", "th", (F.col("start") + F.col("s.k")).alias("start"), F.lit(1).cast("long").alias("n"), "y", "s.string"))
    earliest = (strings.groupBy("y", "string").agg(F.min(F.struct("did", "th", "start")).alias("origin"), F.count("*").alias("places"))
                .where("places > 1").drop("places"))
    across = strings.join(earliest, ["y", "string"]).where(F.col("origin") < F.struct("did", "th", "start")).select("did", "th", "start", "n")
    return found.where("NOT border").select("did", "th", "start", "n").unionByName(across)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(did, n_bytes, n_removed, n_spans, kept_sha256), one row per document."""
    body = C.whole_text(text)
    keyed = docs.select(F.col(doc_id).cast("long").alias("did"), C.text_key(body).alias("th"), body.alias("text"))
    runs = repeated_runs(keyed)
    ends = (repeated_ends(keyed, runs).groupBy("did", "th").agg(F.collect_set(F.col("start") * 128 + F.col("n")).alias("ranges")))
    cuts = (runs.select("did", "th", "whole").join(ends.withColumnsRenamed({"did": "e_did", "th": "e_th"}),
                                                   (F.col("th") == F.col("e_th")) & F.col("did").eqNullSafe(F.col("e_did")), "left")
            .select(F.col("did").alias("c_did"), F.col("th").alias("c_th"), "whole", "ranges"))
    same = (F.col("th") == F.col("c_th")) & F.col("did").eqNullSafe(F.col("c_did"))
    return keyed.join(cuts, same, "left").select("did", "text", "whole", "ranges").mapInArrow(
        _cut_out, "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(C.read(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("did", "doc_id")


QUERIES = {"op7_suffix_dedup": op7_suffix_dedup}
ORACLES: dict[str, str] = {}
