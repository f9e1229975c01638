"""Cross-tokenizer alignment: which ids of tokenizer B stand for the ids of tokenizer A.

Both tokenizers run over every text; byte offsets where tokens of both end cut the two sequences into
groups, and each such offset links the A token and the B token that end there. A link's weight is the
number of links of its id pair in the whole corpus.

1. **Encode** (one pass). Both tokenizers leave certain places uncrossed (see :class:`Aligner`), so a
   worker aligns each distinct piece between them once and texts are put together from pieces. Each
   document gives its digest columns and its links in two parts: groups of one A and one B token with
   equal bytes, where B's id is the one that the **identity map** (A id -> B id of the same bytes, built
   from the two vocabularies) gives, so the A id alone tells the pair; and all other, *irregular* links.
   That is stored (2 bytes a group, 4 an irregular link), as it is read twice.
2. **Count.** Tasks add up identity links in one vector as long as A's vocabulary, and irregular ones
   by pair; one row per (pair, task) is shuffled.
3. **Score.** Three tables of bounded size go to every task: the identity vector (A's vocabulary), the
   highest count per B id (B's vocabulary) and the irregular pairs that hold at least one in
   ``HOT_SHARE`` links (so at most ``HOT_SHARE`` of them). They settle most links where they stand; only
   the other irregular links, one row per (document, pair), enter the pair shuffle: joined with the
   counts, summed by document, joined to the documents' rows.

No pair that is frequent enough to fill a task enters that join, and a document's rows are summed
map-side, so neither a hot pair nor a long document gathers in one task.

Defined cases: null and empty texts, and texts that a tokenizer does not give back byte for byte (for
B, U+2581 reads as a space), have no tokens; null doc_id is a row like others; repeated rows count
each; a very long text needs memory in proportion to itself; ties for a B id's highest count all are
best; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .rolling import Rolling, chunks, text_bytes

#: Fixed values of the contract.
TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"

HOT_SHARE = 65_536
CACHE_PIECES = 300_000
FLUSH_PAIRS = 1_000_000
CHUNK_BYTES = 2_000_000
#: a pair as one number: A id times this plus B id
STRIDE = 1 << 16


# ---- vocabularies ----

def byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies -> bytes: printable Latin-1 stands for itself, the other
    bytes in order for U+0100 and up (the public byte-level convention)."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def a_token_bytes(path: str) -> list[bytes]:
    """Bytes of A's ids (special tokens: their text)."""
    from tokenizers import Tokenizer

    t, of = Tokenizer.from_file(path), byte_alphabet()
    names = sorted(t.get_vocab().items(), key=lambda x: x[1])
    out = [b""] * (names[-1][1] + 1)
    for name, i in names:
        out[i] = bytes(of[c] for c in name) if all(c in of for c in name) else name.encode()
    return out


def b_token_bytes(path: str) -> list[bytes]:
    """Bytes of B's ids: a piece in UTF-8 with U+2581 as space, a byte token as its byte."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """A id -> B id of the same bytes (the highest, so a character's own piece before a byte token),
    -1 where B has none."""
    at = {x: i for i, x in enumerate(b) if x}
    return np.array([at.get(x, -1) for x in a], np.int64)


# ---- alignment ----

class Aligner:
    """Aligns texts by distinct pieces.

    Pieces start at a space or line break whose neighbour before is a character that is surely no
    white space. A's pre-tokens hold white space at their start only, so none crosses such a place, and
    what they see of a run of white space lies in one piece. B's merges cross it only if some piece of
    its vocabulary holds a space after another character or a line break in a longer piece, which is
    looked up; if one does, texts are aligned whole. B adds a space before what it encodes: a piece
    that starts with a space is given without it, one that starts with a line break loses the token of
    the added space.
    """

    #: the last byte of a character that is surely no white space, seen alone or after its lead byte
    GRAPH = np.array([33 <= c < 127 for c in range(256)])
    TWO = np.array([0xC3 <= c <= 0xDF for c in range(256)])

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = a_token_bytes(path_a), b_token_bytes(path_b)
        if max(len(self.bytes_a), len(self.bytes_b)) > STRIDE:
            raise ValueError(f"vocabularies of over {STRIDE} ids")
        self.identity = identity_map(self.bytes_a, self.bytes_b)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in of], np.int64) for of in (self.bytes_a, self.bytes_b))
        width = len(str(STRIDE)) + 1
        self.digits = np.array([str(i).rjust(width - 1, "\0") + " " for i in range(max(len(self.bytes_a), len(self.bytes_b)))]).view(np.uint32).reshape(-1, width).astype(np.uint8)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.by_piece = not any(re.search("[^▁]▁", p) or "\n" in p for p in pieces)
        self.space = self.b.piece_to_id("▁")
        self.forget()

    def piece_starts(self, data: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Places in the bytes of texts (that start at ``docs``) that no token of either side crosses."""
        if not self.by_piece:
            return docs
        gap = (data == 32) | (data == 10)
        sure = self.GRAPH[data]
        sure[1:] |= (data[1:] >= 0x80) & (data[1:] < 0xC0) & self.TWO[data[:-1]]
        cut = np.zeros(len(data), bool)
        cut[1:] = gap[1:] & sure[:-1]
        cut[docs] = True
        return np.flatnonzero(cut)

    def _ends_sure(self, piece: bytes) -> bool:
        return bool(self.GRAPH[piece[-1]] or len(piece) > 1 and 0x80 <= piece[-1] < 0xC0 and self.TWO[piece[-2]])

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A of all texts, their number in each text, and the same of B."""
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        ids_b = [[self.space] if t == " " else b[1:] if t[0] != " " else b for t, b in zip(texts, ids_b, strict=True)]
        return tuple(x for ids in (ids_a, ids_b) for x in (np.fromiter(itertools.chain.from_iterable(ids), np.int64), np.array([len(i) for i in ids], np.int64)))

    def _right(self, ids: np.ndarray, n: np.ndarray, sizes: np.ndarray, of: list[bytes], wholes: list[bytes]) -> np.ndarray:
        """The texts whose tokens' bytes are the text."""
        ends = np.cumsum(n)
        tokens = b"".join([of[i] for i in ids.tolist()])
        if tokens == b"".join(wholes) and (np.add.reduceat(sizes[ids], ends - n) == [len(w) for w in wholes]).all():
            return np.ones(len(wholes), bool)
        return np.array([b"".join([of[i] for i in ids[e - k:e].tolist()]) == w for e, k, w in zip(ends.tolist(), n.tolist(), wholes, strict=True)])

    def _align(self, bundles: list[list[bytes]]) -> tuple[list[list[bytes]], list[tuple]]:
        """Aligns texts that are made of pieces: the ones that could not be aligned piece by piece, and of
        the others' pieces in order (piece, (right, n_a, n_b, n_groups), groups, identity ids, irregular pairs)."""
        wholes = [b"".join(x) for x in bundles]
        a, n_a, b, n_b = self._ids([w.decode() for w in wholes])
        good = self._right(a, n_a, self.sizes_a, self.bytes_a, wholes) & self._right(b, n_b, self.sizes_b, self.bytes_b, wholes)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        pieces = [p for x, g in zip(bundles, good, strict=True) if g for p in x]
        bad = [x for x, g in zip(bundles, good, strict=True) if not g]
        if not pieces:
            return bad, []
        # all texts one after the other: places where tokens of both sides end
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        both_a, both_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        cuts = ends_a[both_a]
        ends = np.cumsum([len(p) for p in pieces])
        if not np.isin(ends, cuts, assume_unique=True).all():
            raise ValueError("a token crosses a place between pieces")
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        last_a, last_b = a[both_a], b[both_b]
        alone = (np.bincount(group_a) == 1) & (np.bincount(group_b) == 1) & (self.identity[last_a] == last_b)
        owner = np.searchsorted(ends, cuts)  # the piece of each group
        # decimal ids, A's and then B's of every group, each with the sign that follows it
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        text = self.digits[np.concatenate([a, b])[order]]
        sign = np.concatenate([np.where(both_a, ord("|"), ord(",")), np.where(both_b, ord(";"), ord(","))])[order]
        text[:, -1] = sign
        shown = text != 0
        flat, upto = text[shown].tobytes(), np.cumsum(shown.sum(1))
        per_a, per_b = (np.bincount(np.searchsorted(ends, x), minlength=len(pieces)) for x in (ends_a, ends_b))
        stops = upto[np.cumsum(per_a + per_b) - 1]
        groups = [flat[i:j - 1] for i, j in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]
        counts = np.stack([np.ones(len(pieces), np.int64), per_a, per_b, np.bincount(owner, minlength=len(pieces))], axis=1)
        parts = [(links, np.bincount(owner[of], minlength=len(pieces))) for links, of in
                 ((last_a[alone], alone), (last_a[~alone] * STRIDE + last_b[~alone], ~alone))]
        return bad, [(pieces, counts, groups, parts)]

    def forget(self) -> None:
        """Empties what is kept by piece: counts (right, n_a, n_b, n_groups), groups, and links with
        the places where each piece's end."""
        self.known: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int64)
        self.links = [(np.zeros(0, np.int64), np.zeros(1, np.int64))] * 2

    def learn(self, pieces: list[bytes]) -> None:
        """Aligns new pieces, many to a text where a piece's end is as sure as the places between pieces."""
        tidy = [p for p in pieces if self.by_piece and self._ends_sure(p)]
        bundles = [tidy[k:k + 64] for k in range(0, len(tidy), 64)] + [[p] for p in pieces if not (self.by_piece and self._ends_sure(p))]
        bad: list[list[bytes]] = []
        for k in range(0, len(bundles), 512):
            wrong, made = self._align(bundles[k:k + 512])
            bad += wrong
            self._keep(made)
        singles = [[p] for x in bad if len(x) > 1 for p in x]
        wrong = [p for x in bad if len(x) == 1 for p in x]
        for k in range(0, len(singles), 4096):
            more, made = self._align(singles[k:k + 4096])
            wrong += [p for x in more for p in x]
            self._keep(made)
        n = len(wrong)
        none = (np.zeros(0, np.int64), np.zeros(n, np.int64))
        self._keep([(wrong, np.zeros((n, 4), np.int64), [b""] * n, [none, none])])

    def _keep(self, made: list[tuple]) -> None:
        for pieces, counts, groups, parts in made:
            self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces)), strict=True))
            self.groups += groups
            self.counts = np.concatenate([self.counts, counts])
            self.links = [(np.concatenate([flat, more]), np.concatenate([ends, ends[-1] + np.cumsum(n)]))
                          for (flat, ends), (more, n) in zip(self.links, parts, strict=True)]

    def texts(self, texts: list[bytes]) -> list[tuple]:
        """(n_a, n_b, n_groups, groups_sha256, identity ids, irregular pairs) of each text."""
        none = (0, 0, 0, "", np.zeros(0, np.uint16), np.zeros(0, np.uint32))
        out = [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        if not full:
            return out
        raw = b" " + b" ".join([texts[i] for i in full])
        docs = np.concatenate([[0], np.cumsum([len(texts[i]) + 1 for i in full])])[:-1]
        data = np.frombuffer(raw, np.uint8)
        starts = self.piece_starts(data, docs)
        stops = np.append(starts[1:], len(data))
        codes, _ = pd.factorize(Rolling(data).pieces(starts, stops))
        first = np.zeros(codes.max() + 1, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        pieces = [raw[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        if len(self.known) > CACHE_PIECES:
            self.forget()
        self.learn(list({p for p in pieces if p not in self.known}))
        place = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))[codes]
        at = np.searchsorted(starts, docs)
        ends = np.append(at[1:], len(place)).tolist()
        right, n_a, n_b, n_groups = np.add.reduceat(self.counts[place], at, axis=0).T.tolist()
        same, other = (self._flat(k, place, at) for k in (0, 1))
        places = place.tolist()
        for k, i in enumerate(full):
            a, b = int(at[k]), ends[k]
            if right[k] == b - a:
                digest = hashlib.sha256(b";".join([self.groups[p] for p in places[a:b]])).hexdigest()
                out[i] = (n_a[k], n_b[k], n_groups[k], digest, same[k].astype(np.uint16), other[k].astype(np.uint32))
        return out

    def _flat(self, kind: int, place: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Links of one kind of the pieces at ``place``, by text."""
        flat, ends = self.links[kind]
        n = ends[place + 1] - ends[place]
        upto = np.cumsum(n)
        links = flat[np.repeat(ends[place] - (upto - n), n) + np.arange(upto[-1])]
        return np.split(links, (upto - n)[at][1:])


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker and pair of tokenizers."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


ALIGNED = "id long, n_a long, n_b long, n_groups long, groups_sha256 string, same binary, other binary"


def _encode(path_a: str, path_b: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b)
        for batch in batches:
            for lo, hi in chunks(text_bytes(batch.column(1))[1], CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                rows = align.texts([t.as_py().encode() for t in part.column(1)])
                cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *cols, pa.array([r[3] for r in rows]), *(pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (4, 5))],
                    names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "same", "other"])

    return run


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, n_a, n_b, n_groups, groups_sha256, same, other) per document, stored: ``same`` holds the
    A ids of identity links (unsigned 16 bit), ``other`` the irregular pairs (unsigned 32 bit)."""
    body = docs.select(F.col(doc_id).cast("long").alias("id"), C.whole_text(text).alias("text"))
    return C.written(body.mapInArrow(_encode(path_a, path_b), ALIGNED).withColumn("row", F.monotonically_increasing_id()), "aligned")


# ---- counts ----

def _counts(identity: np.ndarray):
    """(same, other) -> (pair, own, n): the identity vector (own) and the irregular pairs of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(len(identity), np.int64)
        pairs, counts, held = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def rows(pair, own, n):
            return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.full(len(pair), own)), pa.array(n)], names=["pair", "own", "n"])

        def merged():
            some, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            keys, at = np.unique(np.concatenate([pairs, some]), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, np.concatenate([counts, n]))
            held.clear()
            return keys, sums

        size = 0
        for batch in batches:
            for same, other in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.frombuffer(same.as_buffer(), np.uint16)
                if len(ids):
                    vector += np.bincount(ids, minlength=len(vector))
                held.append(np.frombuffer(other.as_buffer(), np.uint32).astype(np.int64))
                size += len(held[-1])
                if size >= FLUSH_PAIRS:
                    pairs, counts = merged()
                    size = 0
                    if len(pairs) >= FLUSH_PAIRS:
                        yield rows(pairs, False, counts)
                        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, counts = merged()
        yield rows(pairs, False, counts)
        seen = np.flatnonzero(vector)
        yield rows(seen * STRIDE + identity[seen], True, vector[seen])

    return run


def pair_counts(links: DataFrame, identity: np.ndarray) -> DataFrame:
    """(pair, own, a, b, n): links of each id pair in the corpus; ``own``: it is in the identity map."""
    made = links.select("same", "other").mapInArrow(_counts(identity), "pair long, own boolean, n long")
    total = made.groupBy("pair", "own").agg(F.sum("n").alias("n"))
    return C.cut(total.select("pair", "own", F.expr(f"pair div {STRIDE}").alias("a"), F.expr(f"pair % {STRIDE}").alias("b"), "n"))


# ---- scores ----

KEPT = ("row", "id", "n_a", "n_b", "n_groups", "groups_sha256")
SCORED = "row long, id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, cold array<bigint>, times array<bigint>"


def _scores(identity: np.ndarray, vector: np.ndarray, best: np.ndarray, hot: np.ndarray, hot_n: np.ndarray):
    """Rows of :func:`aligned` -> n_best, count_sum, cold and times in place of same and other: what the
    tables settle, and the pairs that they do not hold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = vector == best[np.maximum(identity, 0)]  # identity links that are their B id's best
        hot_top = hot_n == best[hot % STRIDE] if len(hot) else np.zeros(0, bool)
        for batch in batches:
            n_best, count_sum, cold, times = [], [], [], []
            for same, other in zip(batch.column("same"), batch.column("other"), strict=True):
                ids = np.frombuffer(same.as_buffer(), np.uint16)
                pairs, n = np.unique(np.frombuffer(other.as_buffer(), np.uint32).astype(np.int64), return_counts=True)
                at = np.searchsorted(hot, pairs)
                known = np.zeros(len(pairs), bool)
                inside = at < len(hot)
                known[inside] = hot[at[inside]] == pairs[inside]
                place, m = at[known], n[known]
                n_best.append(int(top[ids].sum() + (m * hot_top[place]).sum()))
                count_sum.append(int(vector[ids].sum() + (m * hot_n[place]).sum()))
                cold.append(pairs[~known])
                times.append(n[~known])
            ends = np.concatenate([[0], np.cumsum([len(c) for c in cold])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(np.int64))) for x in (cold, times)] if cold else \
                [pa.array([], pa.list_(pa.int64()))] * 2
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEPT), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), *lists],
                                             names=[*KEPT, "n_best", "count_sum", "cold", "times"])

    return run


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, doc_id: str = "doc_id", text: str = "text",
          hot_share: int = HOT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Two frames: per document (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and
    the alignment itself, (pair, own, a, b, n), the links of each id pair."""
    import public_tokenizers

    path_a, path_b = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
    bytes_a, bytes_b = a_token_bytes(path_a), b_token_bytes(path_b)
    identity = identity_map(bytes_a, bytes_b)
    links = aligned(docs, path_a, path_b, doc_id, text)
    counts = pair_counts(links, identity)
    vector = np.zeros(len(identity), np.int64)
    for r in counts.where("own").select("a", "n").collect():  # at most A's vocabulary
        vector[r.a] = r.n
    best = np.zeros(len(bytes_b), np.int64)
    for r in counts.groupBy("b").agg(F.max("n").alias("n")).collect():  # at most B's vocabulary
        best[r.b] = r.n
    total = links.agg(F.coalesce(F.sum("n_groups"), F.lit(0))).first()[0]
    irregular = counts.where("NOT own")
    frequent = sorted((r.pair, r.n) for r in irregular.where(F.col("n") * hot_share >= total).collect())  # at most hot_share
    hot, hot_n = (np.array([x[k] for x in frequent], np.int64) for k in (0, 1))
    scored = C.written(links.mapInArrow(_scores(identity, vector, best, hot, hot_n), SCORED), "alignment-scores")
    cold = scored.select("row", F.explode(F.arrays_zip("cold", "times")).alias("p")).select("row", F.col("p.cold").alias("pair"), F.col("p.times").alias("times"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    weights = irregular.where(F.col("n") * hot_share < total).join(F.broadcast(most), "b").select("pair", F.col("n").alias("weight"), (F.col("n") == F.col("most")).alias("is_best"))
    rest = (cold.join(weights, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("weight")).alias("more_sum")))
    out = scored.join(rest, "row", "left").select(
        "id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
    return out, counts


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = align(C.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnsRenamed({"id": "doc_id"})


QUERIES = {"op13_cross_tokenizer": op13_cross_tokenizer}
#: Tokenizers have no SQL form; the query is tested against brute force.
ORACLES: dict[str, str] = {}
