"""Token ids in a binary file format with random access: directly addressable codes.

Ids are split into chunks of ``CHUNK_BITS`` bits, low chunk first. Level 0 holds the low chunk of
every id; a bitmap beside it says which ids go on, and level 1 holds the next chunk of just those,
in order, and so on. The chunk of id i at the next level is at rank(bitmap, i), which a directory of
counts before every block of ``RANK_BITS`` bits answers with one popcount. So any id is read
without decoding a block.

A file segment is one row of a Parquet table: first global id position, the documents it holds
(ids and ends) and the payload. Documents never cross segments; a segment closes at
``SEGMENT_IDS`` ids. The container is Parquet because executors can write only through Spark's
writers to a store that Spark alone can reach.

Ascending doc_id order comes from range partitions (sampled splitters), each sorted by itself;
``start`` is the ids of earlier partitions (one number per partition) plus the running count that a
segment has of its partition. Documents of one doc_id are ordered by the hash of their text, in
ranges and inside them alike.

Defined cases: null text is empty (only the end id); doc_id null comes first; repeated rows are
documents of their own; an empty table gives no segment; other columns are dropped.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from .rolling import Rolling

#: Fixed values of the contract.
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_IDS = 250_000
CACHE_PIECES = 500_000
MAGIC = b"DAC1"


# ---- the code ----

def _bitmap(flags: np.ndarray) -> tuple[bytes, bytes]:
    """Bits, padded to whole rank blocks, and the count of ones before each block."""
    padded = np.zeros(-(-len(flags) // RANK_BITS) * RANK_BITS, np.uint8)
    padded[: len(flags)] = flags
    before = np.concatenate([[0], np.cumsum(padded.reshape(-1, RANK_BITS).sum(1, dtype=np.int64))])[:-1] if len(padded) else np.zeros(0, np.int64)
    return np.packbits(padded, bitorder="little").tobytes(), before.astype("<u4").tobytes()


def pack(ids: np.ndarray) -> bytes:
    """A segment's payload: header (magic, chunk bits, levels, ids), sizes of each level, levels."""
    rest, levels = np.asarray(ids, np.uint32), []
    while True:
        low, rest = (rest & ((1 << CHUNK_BITS) - 1)).astype(np.uint8), rest >> CHUNK_BITS
        more = rest > 0
        levels.append((low.tobytes(), *_bitmap(more)))
        rest = rest[more]
        if not len(rest):
            break
    head = struct.pack("<4sBBI", MAGIC, CHUNK_BITS, len(levels), len(ids))
    sizes = b"".join(struct.pack("<III", *map(len, level)) for level in levels)
    return head + sizes + b"".join(itertools.chain.from_iterable(levels))


class Segment:
    """Random access to the ids of one payload; the buffers are views, nothing is decoded ahead."""

    def __init__(self, payload: bytes):
        magic, _, count, self.n = struct.unpack_from("<4sBBI", payload)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = struct.calcsize("<4sBBI")
        sizes = [struct.unpack_from("<III", payload, at + 12 * k) for k in range(count)]
        at += 12 * count
        self.levels = []
        for chunks, bits, ranks in sizes:
            self.levels.append((np.frombuffer(payload, np.uint8, chunks, at),
                                np.frombuffer(payload, np.uint8, bits, at + chunks),
                                np.frombuffer(payload, "<u4", ranks // 4, at + chunks + bits)))
            at += chunks + bits + ranks

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        i, value, shift = int(i), 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self._rank(bits, ranks, i), shift + CHUNK_BITS
        return value

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i: the directory, and the bits of the block before i."""
        block = i // RANK_BITS
        first = block * RANK_BITS // 8
        inside = int.from_bytes(bits[first:(i >> 3) + 1].tobytes(), "little") & ((1 << (i - block * RANK_BITS)) - 1)
        return int(ranks[block]) + inside.bit_count()

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop): each level is read at the ranks of the slice's two ends."""
        start, stop = int(start), int(stop)
        out, at, shift = np.zeros(stop - start, np.uint32), None, 0
        for chunks, bits, ranks in self.levels:
            if stop <= start:
                break
            got = chunks[start:stop].astype(np.uint32) << shift
            if at is None:
                out[:] = got
            else:
                out[at] |= got
            more = np.unpackbits(bits[start >> 3:(stop + 7) >> 3], bitorder="little")[start & 7:(start & 7) + stop - start].astype(bool)
            at = np.flatnonzero(more) if at is None else at[more]
            if not len(at):
                break
            start, stop, shift = self._rank(bits, ranks, start), self._rank(bits, ranks, start) + len(at), shift + CHUNK_BITS
        return out


# ---- tokens ----

CHUNK_BYTES = 2_000_000


_LETTER = np.array([chr(c).isalpha() and c < 128 for c in range(256)])
_PUNCT = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])


def _starts(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes whose only white space is space and line break that no pre-token of
    byte-level BPE crosses. ``docs``: where each text starts."""
    line, space = data == 10, (data == 10) | (data == 32)
    cut = np.zeros(len(data) + 1, bool)
    cut[docs] = True
    fresh = cut[:-1].copy()
    inside = ~fresh[1:]  # i and i - 1 are of one text
    gap, after = space[1:], space[:-1]
    cut[1:-1] |= inside & gap & ~after                 # a run of white space starts
    cut[1:-1] |= inside & ~gap & line[:-1]             # a line break ends it
    last = space[:-1] & ~space[1:] & inside            # its last place, before a word, stands alone or leads the word
    cut[:-2] |= last
    letter = _LETTER[data]
    lead, tail = data[:-1], data[1:]                   # two-byte letters U+00C0 to U+024F but for the two signs among them
    two = (lead == 0xC3) & (tail >= 0x80) & (tail != 0x97) & (tail != 0xB7)
    two |= (lead >= 0xC4) & (lead <= 0xC8)
    two |= (lead == 0xC9) & (tail <= 0x8F)
    letter[1:] |= two & (tail >= 0x80)
    cut[1:-1] |= inside & _PUNCT[data[1:]] & letter[:-1]  # letters end before ASCII punctuation
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Whole texts to ids with the tokenizers library. Byte-level BPE never joins across the start
    of a space-led word, a line break, or the end of letters before ASCII punctuation, so the
    library encodes each distinct piece between such places once per worker, and ids are put
    together by lookup; texts with other white space, or with the string of a special token (which the
    library takes for the token, unless ``plain_specials``), go to the library whole."""

    OTHER_SPACE = re.compile(r"[^\S \n]")
    #: bytes that are, or may start, other white space
    ODD = np.isin(np.arange(256), [9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3])

    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials  # their strings in a text are then ordinary text
        self.specials = [] if plain_specials else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self._encode(["\n"])[0][0]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.at, self.length = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Encodes new pieces, many to a string with line breaks between: a place nothing crosses."""
        blank = [p for p in pieces if not p.strip(b" \n")]
        for piece, ids in zip(blank, self._encode([p.decode() for p in blank]), strict=True):
            self._keep([piece], np.array([*ids, self.line], np.uint32), np.array([len(ids)]))
        plain = [p for p in pieces if p.strip(b" \n")]
        for k in range(0, len(plain), 8192):
            some = plain[k:k + 8192]
            joined = [(b"\n".join(some[i:i + 64]) + b"\n").decode() for i in range(0, len(some), 64)]
            ids = np.fromiter(itertools.chain.from_iterable(self._encode(joined)), np.uint32)
            self._keep(some, ids, np.flatnonzero(ids == self.line))

    def _keep(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Ids of the pieces, each followed by a line break at one of ``ends``."""
        k, n = len(self.known), len(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while k + n > len(self.at):
            self.at, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.length))
        starts = np.concatenate([[0], ends[:-1] + 1])
        self.flat[self.used:self.used + len(ids)] = ids
        self.at[k:k + n], self.length[k:k + n] = starts + self.used, ends - starts
        self.known.update(zip(pieces, range(k, k + n), strict=True))
        self.used += len(ids)

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        raw = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        if not raw:
            return out
        data, docs = np.frombuffer(raw, np.uint8), (ends - sizes)[sizes > 0]
        starts = _starts(data, docs)
        stops = np.append(starts[1:], len(data))
        codes, _ = pd.factorize(Rolling(data).pieces(starts, stops))
        first = np.zeros(codes.max() + 1, np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        pieces = [raw[a:b] for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)]
        if len(self.known) > CACHE_PIECES:
            self.forget()
        known = self.known
        self._learn(list({p for p in pieces if p not in known}))
        place = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))[codes]
        n = self.length[place]
        upto = np.cumsum(n)
        ids = self.flat[np.repeat(self.at[place] - (upto - n), n) + np.arange(upto[-1])]
        first_piece = np.searchsorted(starts, docs)
        cuts = np.append((upto - n)[first_piece], upto[-1])
        for k, i in enumerate(np.flatnonzero(sizes).tolist()):
            out[i] = ids[cuts[k]:cuts[k + 1]]
        return out

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        held: list[bytes] = []
        size = 0
        for t in texts:
            held.append(t.encode())
            size += len(held[-1])
            if size >= CHUNK_BYTES:
                out += self._split(held)
                held, size = [], 0
        return out + self._split(held)

    def _split(self, texts: list[bytes]) -> list[np.ndarray]:
        """Texts with other white space go to the library whole, the rest by pieces."""
        joined = b"".join(texts)
        if not self.ODD[np.frombuffer(joined, np.uint8)].any() and not any(s in joined for s in self.specials):
            return self._chunk(texts)
        whole = [bool(self.OTHER_SPACE.search(t.decode())) or any(s in t for s in self.specials) for t in texts]
        out = self._chunk([b"" if w else t for t, w in zip(texts, whole, strict=True)])
        at = [i for i, w in enumerate(whole) if w]
        for i, ids in zip(at, self._encode([texts[i].decode() for i in at]), strict=True):
            out[i] = np.array(ids, np.uint32)
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain_specials: bool = False) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
    if (path, plain_specials) not in _ENCODERS:
        _ENCODERS[path, plain_specials] = Encoder(path, plain_specials)
    return _ENCODERS[path, plain_specials]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- files ----

#: no_id marks documents whose doc_id is null (0 in doc_ids)
SEGMENT_SCHEMA = "part int, inside long, n_ids long, doc_ids array<long>, no_id array<boolean>, ends array<long>, payload binary"


def _segments(path: str, end_id: int, plain_specials: bool):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, inside, held, docs, none, size = TaskContext.get().partitionId(), 0, [], [], [], 0
        encode = encoder(path, plain_specials)

        def close():
            ids = np.concatenate(held)
            return pd.DataFrame({"part": [part], "inside": [inside], "n_ids": [len(ids)], "doc_ids": [docs], "no_id": [none],
                                 "ends": [np.cumsum([len(x) for x in held]).tolist()], "payload": [pack(ids)]})

        for batch in batches:
            for lo in range(0, len(batch), 500):
                some = batch.iloc[lo:lo + 500]
                for doc_id, no_id, ids in zip(some["id"].tolist(), some["no_id"].tolist(), encode(some["text"].tolist()), strict=True):
                    held.append(np.append(ids, np.uint32(end_id)))
                    docs.append(doc_id)
                    none.append(no_id)
                    size += len(ids) + 1
                    if size >= SEGMENT_IDS:
                        yield close()
                        held, docs, none, size, inside = [], [], [], 0, inside + size
        if held:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text",
                 plain_specials: bool = False) -> None:
    """The documents' ids as segments under ``path`` in ascending doc_id order. With ``plain_specials``
    the string of a special token in a text is ordinary text, so no text can forge one."""
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), C.whole_text(text).alias("text"))
               .withColumn("key", C.text_key(F.col("text"))).repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key"))
    ordered = ordered.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "text")
    ordered.mapInPandas(_segments(tokenizer, end_id, plain_specials), SEGMENT_SCHEMA).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``first``, the number of ids before each: those of earlier partitions (one row
    per partition that wrote, so a small table) and those before it in its partition."""
    seg = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = seg.groupBy("part").agg(F.sum("n_ids").alias("ids")).select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return seg.join(F.broadcast(base), "part").withColumn("first", F.col("base") + F.col("inside"))


def _documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_ids, no_id, ends, payload, first) -> (id, no_id, start, n_tokens, ids_crc32)."""
    for batch in batches:
        for i in range(len(batch)):
            seg, ends = Segment(batch.column(3)[i].as_buffer()), batch.column(2)[i].values.to_numpy()
            starts = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(seg.slice(a, b).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[i].values, batch.column(1)[i].values, pa.array(starts + batch.column(4)[i].as_py()), pa.array(ends - starts), pa.array(crc, pa.int64())],
                names=["id", "no_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files."""
    index = read_index(spark, path).select("doc_ids", "no_id", "ends", "payload", "first")
    back = index.mapInArrow(_documents, "id long, no_id boolean, start long, n_tokens long, ids_crc32 long")
    return back.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "start", "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, **options) -> DataFrame:
    """Writes the token files (a new folder of the shared one unless named) and reads them back."""
    spark = docs.sparkSession
    path = path or C.new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer or tokenizer_path(), **options)
    return read_tokens(spark, path)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(C.read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op3_token_files": op3_token_files}
ORACLES: dict[str, str] = {}
