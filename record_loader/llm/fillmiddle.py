"""Fill-in-the-middle transformation with content-defined chunk memoization.

A document is cut at two of its line ends, drawn from a hash of its id, into prefix, middle and
suffix, and written as prefix-suffix-middle (psm) or suffix-prefix-middle (spm) with sentinels.

Where the cuts fall is found without scanning a text twice:

1. A rolling hash over ``WINDOW`` bytes cuts a text into chunks where the hash's low bits are zero, so
   equal passages give equal chunks wherever they stand.
2. A worker keeps a summary per chunk content: line ends, code points, whether a sentinel lies
   inside, first and last bytes. A chunk's hash finds the summary and its bytes verify it; new
   chunks are summarised once. The memo is cleared at ``MEMO_BYTES``, which changes no result.
3. Sums of the summaries give a text's units and code points, and its sentinels: those inside chunks
   and those across borders, from the last bytes of one chunk and the first of the next. The cut after
   a unit lies in the chunk where the running count of line ends reaches it; only that chunk is looked at.

The task returns places only; the texts are put together by column expressions, so a row never comes
back from Python with its text. Nothing is shuffled; a lost executor's rows are simply made again.

Defined cases: null text is empty; an empty text or one that holds a sentinel is plain (its own
text); null doc_id draws from the word ``null``; repeated rows give equal rows; a very long text needs
memory in proportion to itself; an empty table gives no rows; other columns are carried, and one named
like an output column is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .rolling import Rolling, U, chunks, mix, text_bytes

#: Fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
FIM_PERCENT = 100
SPM_PERCENT = 50

WINDOW = 32
CHUNK_BITS = 9
MEMO_BYTES = 32_000_000
BATCH_BYTES = 1_000_000

OUTPUTS = ("fim_text", "fim_form", "fim_units", "fim_prefix_chars", "fim_middle_chars")


@dataclass(frozen=True)
class Sentinels:
    prefix: str = PREFIX
    suffix: str = SUFFIX
    middle: str = MIDDLE

    def __post_init__(self):
        """Texts are told from sentinels by their first places, so no sentinel may overlap itself or another."""
        all_ = (self.prefix, self.suffix, self.middle)
        if any(not s for s in all_) or len(set(all_)) < 3:
            raise ValueError("three different sentinels are needed")
        for a in all_:
            for b in all_:
                if (a != b and a in b) or any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                    raise ValueError(f"sentinels overlap: {a!r}, {b!r}")

    def all(self) -> tuple[bytes, ...]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


# ---- chunks and their summaries ----

def chunk_ends(rolling: Rolling, start: int, stop: int, grams: np.ndarray) -> np.ndarray:
    """Ends of the content-defined chunks of bytes [start, stop) of a batch."""
    inside = grams[start:max(stop - WINDOW, start)]  # the window that ends a chunk lies in the text, before its last byte
    return np.append(np.flatnonzero(inside & U((1 << CHUNK_BITS) - 1) == 0) + start + WINDOW, stop)


class Memo:
    """Summaries by chunk content."""

    def __init__(self, sentinels: Sentinels):
        self.marks = sentinels.all()
        self.reach = max(map(len, self.marks)) - 1
        self.hits = self.misses = 0
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, tuple] = {}
        self.size = 0

    def summary(self, key: int, chunk: bytes) -> tuple:
        """(bytes, line ends, code points, holds a sentinel, first bytes, last bytes)."""
        found = self.known.get(key)
        if found is not None and found[0] == chunk:
            self.hits += 1
            return found
        self.misses += 1
        made = (chunk, chunk.count(b"\n"), code_points(chunk), any(m in chunk for m in self.marks), chunk[:self.reach], chunk[-self.reach:] if self.reach else b"")
        if self.size > MEMO_BYTES:
            self.clear()
        if found is None:
            self.known[key] = made
            self.size += len(chunk) + 200
        return made


def code_points(data: bytes) -> int:
    """Code points that start in UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


class Located:
    """A text's units, code points and sentinels from its chunks' summaries, and places of its cuts."""

    def __init__(self, parts: list[tuple], reach: int, marks: tuple[bytes, ...]):
        self.parts = parts
        self.lines = np.cumsum([p[1] for p in parts])
        self.chars = np.cumsum([p[2] for p in parts])
        self.marked = any(p[3] for p in parts)
        tail = b""
        for p in parts:
            if self.marked:
                break
            self.marked = any(m in tail + p[4] for m in marks)
            tail = (tail + p[5])[-reach:] if reach else b""
        ended = bool(parts) and parts[-1][0].endswith(b"\n")
        self.units = (int(self.lines[-1]) + (not ended)) if parts else 0

    def chars_until(self, units: int) -> int:
        """Code points of the first ``units`` units."""
        if units <= 0:
            return 0
        if units > self.lines[-1]:
            return int(self.chars[-1])
        k = int(np.searchsorted(self.lines, units))
        before = int(self.lines[k - 1]) if k else 0
        chunk, at = self.parts[k][0], -1
        for _ in range(units - before):
            at = chunk.index(b"\n", at + 1)
        return (int(self.chars[k - 1]) if k else 0) + code_points(chunk[:at + 1])


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 from the id's hash."""
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(h[k:k + 8], 16) for k in (0, 8, 16, 24))


_MEMOS: dict[Sentinels, Memo] = {}

PLACES = "struct<units: long, form: string, prefix_end: long, middle_end: long, chars: long>"


def _places(seed: int, fim_percent: int, spm_percent: int, sentinels: Sentinels):
    def run(ids: pa.Array, texts: pa.Array) -> pa.Array:
        memo = _MEMOS.setdefault(sentinels, Memo(sentinels))
        data, offsets = text_bytes(texts)
        out = []
        for lo, hi in chunks(offsets, BATCH_BYTES):
            raw = data[offsets[lo]:offsets[hi]]
            at = (offsets[lo:hi + 1] - offsets[lo]).tolist()
            rolling = Rolling(raw)
            grams = mix(rolling.grams(WINDOW))
            body = raw.tobytes()
            for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                ends = chunk_ends(rolling, a, b, grams) if b > a else np.zeros(0, np.int64)
                starts = np.concatenate([[a], ends[:-1]]).astype(np.int64) if b > a else ends
                keys = rolling.pieces(starts, ends).tolist()
                text = Located([memo.summary(k, body[s:e]) for k, s, e in zip(keys, starts.tolist(), ends.tolist(), strict=True)], memo.reach, memo.marks)
                h1, h2, h3, h4 = draws(ids[lo + i].as_py(), seed)
                n = text.units
                chars = int(text.chars[-1]) if n else 0
                if not n or text.marked or h3 % 100 >= fim_percent:
                    out.append((n, "plain", None, None, chars))
                    continue
                first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
                out.append((n, "spm" if h4 % 100 < spm_percent else "psm", text.chars_until(first), text.chars_until(second), chars))
        names = ("units", "form", "prefix_end", "middle_end", "chars")
        return pa.StructArray.from_arrays([pa.array([r[k] for r in out], pa.string() if k == 1 else pa.int64()) for k in range(5)], names=list(names))

    return run


# ---- the operator ----

def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, sentinels: Sentinels = Sentinels()) -> DataFrame:
    """The documents with ``fim_text`` (the training text), ``fim_form`` (psm, spm or plain),
    ``fim_units``, and ``fim_prefix_chars`` and ``fim_middle_chars`` (code points; null if plain)."""
    places = F.arrow_udf(_places(seed, fim_percent, spm_percent, sentinels), PLACES)
    made = docs.select(C.row_of(docs), F.col(f"`{doc_id}`").cast("long").alias("id"), C.whole_text(F.col(f"`{text}`")).alias("body"))
    made = made.withColumn("at", places("id", "body"))
    a, b = F.col("at.prefix_end").cast("int"), F.col("at.middle_end").cast("int")
    prefix, middle = F.substring("body", F.lit(1), a), F.substring("body", a + 1, b - a)
    suffix = F.substring("body", b + 1, F.col("at.chars").cast("int") - b)
    p, s, m = (F.lit(x) for x in (sentinels.prefix, sentinels.suffix, sentinels.middle))
    whole = (F.when(F.col("at.form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
             .when(F.col("at.form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("body")))
    return C.unpacked(made, docs, fim_text=whole, fim_form=F.col("at.form"), fim_units=F.col("at.units"),
                      fim_prefix_chars=F.col("at.prefix_end"), fim_middle_chars=F.col("at.middle_end") - F.col("at.prefix_end"))


def restored(text: str | Column = "fim_text", form: str | Column = "fim_form", sentinels: Sentinels = Sentinels()) -> Column:
    """The document's text from the training text and its form."""
    text, form = (F.col(x) if isinstance(x, str) else x for x in (text, form))
    parts = F.split(text, "|".join(re.escape(x) for x in (sentinels.prefix, sentinels.suffix, sentinels.middle)), 4)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(text))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(C.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", F.col("fim_units").alias("n"), F.col("fim_form").alias("form"),
                       F.col("fim_prefix_chars").alias("prefix_chars"), F.col("fim_middle_chars").alias("middle_chars"),
                       F.sha2("fim_text", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


OP12_SQL = """
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, body, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM lines),
cut AS (
  SELECT doc_id, body, n, form, array_to_string(units[1:least(c1, c2)], '') AS p,
         array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(units[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE body END)
         AS output_sha256,
       sha256(body) AS restored_sha256
FROM cut
"""

QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}
ORACLES = {"op12_fill_in_middle": OP12_SQL}
