"""Quality by compression: one zstandard dictionary from good and one from bad labelled text; a
text's compressed sizes under both, normalised by its size, become a calibrated score.

Learning uses a bounded sample of labelled documents (``SAMPLE_DOCS`` per class and ``SAMPLE_CHUNKS``
chunks of their whole texts, both by smallest hash): one half for the dictionaries, the other, whose
documents no dictionary has seen, for the calibration. Scoring reads every whole text in chunks, so
the dictionaries count throughout a long text, and runs in tasks over Arrow batches without a
shuffle; the two dictionaries (``DICT_BYTES`` each) and six coefficients are all that is sent out.

Calibration is a logistic regression on the normalised size difference, the normalised size under
the good dictionary and the log of the text's size, weighted so both classes count as in the sample.

Defined cases: null text is empty; the empty text has sizes 0 and is scored like others; without
labels of both classes every score is the constant 0.5; null doc_id is held out (never learnt);
repeated rows are scored alike; other columns are carried untouched, but
for quality_score and quality_predicted, which are replaced. Beside the difference, the calibration reads the good
size a byte, the log size and its product with the difference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SAMPLE_DOCS = 1200
SAMPLE_CHUNKS = 4000
CHUNK = 2048
DICT_BYTES = 64 * 1024
LEVEL = 3
PREDICT_AT = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def chunks(raw: bytes) -> list[bytes]:
    return [raw[i:i + CHUNK] for i in range(0, len(raw), CHUNK)]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str) -> list[tuple[int, int, list[bytes]]]:
    """(class, half, chunks) of at most SAMPLE_DOCS documents and SAMPLE_CHUNKS chunks a class and half."""
    order = F.xxhash64(F.lit("sample"), "doc_id")
    known = labels.where(~held_out(F.col("doc_id")) & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label"), order.alias("h"))
    picked = [known.where(F.col("label") == k).orderBy("h", "doc_id").limit(SAMPLE_DOCS) for k in (0, 1)]  # bounded by parameter
    ids = C.cut(picked[0].unionByName(picked[1]).distinct())
    text = docs.select(F.col("doc_id"), F.encode(C.whole_text(), "UTF-8").alias("raw")).join(F.broadcast(ids), "doc_id")
    cuts = F.expr(f"transform(sequence(0, greatest(0, octet_length(raw) - 1) div {CHUNK}), i -> struct(i AS k, substring(raw, i * {CHUNK} + 1, {CHUNK}) AS c))")
    part = text.withColumn("half", (F.col("h") % 2 == 0).cast("int")).select("doc_id", "label", "half", F.explode(cuts).alias("x")).select("*", "x.*")
    rows = [r for y in (0, 1) for half in (0, 1) for r in part.where((F.col("label") == y) & (F.col("half") == half)).orderBy(
        F.xxhash64("doc_id", "k"), "doc_id", "k").limit(SAMPLE_CHUNKS).select("label", "half", "doc_id", "c").collect()]  # bounded by parameter
    whole: dict[tuple, list[bytes]] = {}
    for r in rows:
        whole.setdefault((r.label, r.half, r.doc_id), []).append(bytes(r.c))
    return [(y, half, c) for (y, half, _), c in sorted(whole.items(), key=lambda kv: kv[0])]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples to train on are used as they are."""
    some = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(DICT_BYTES, some, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(some)[:DICT_BYTES]


def _compressor(data: bytes) -> zstandard.ZstdCompressor:
    kind = zstandard.ZstdCompressionDict(data)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=kind, write_content_size=False, write_checksum=False, write_dict_id=False)


class Sizes:
    """Normalised compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = _compressor(good), _compressor(bad)
        self.frame = len(self.good.compress(b""))

    def __call__(self, parts: list[bytes]) -> tuple[float, float, float]:
        size = sum(map(len, parts))
        if not size:
            return 0.0, 0.0, 0.0
        g = sum(len(self.good.compress(p)) - self.frame for p in parts)
        b = sum(len(self.bad.compress(p)) - self.frame for p in parts)
        return (b - g) / max(g, b, 1), g / size, float(np.log1p(size))


def features(x: np.ndarray) -> np.ndarray:
    """Of rows (difference, good size, log size): the terms of the regression."""
    d, g, n = x[:, 0], x[:, 1], x[:, 2]
    return np.stack([np.ones_like(d), d, g, g * g, n, d * n], axis=1)


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    f, w = features(x), np.zeros(6)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        grad = f.T @ (p - y) + 1e-2 * w
        hess = (f * (p * (1 - p))[:, None]).T @ f + 1e-2 * np.eye(6)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[bytes, bytes, list[float]] | None:
    """(good dictionary, bad dictionary, coefficients); None without both classes."""
    sample = labelled_sample(docs, labels, label)
    pools = {y: [c for k, half, cs in sample if k == y and half == 0 for c in cs] for y in (0, 1)}
    rest = [(y, cs) for y, half, cs in sample if half == 1] or [(y, cs) for y, _, cs in sample]
    if not pools[0] or not pools[1]:
        return None
    good, bad = dictionary(pools[1]), dictionary(pools[0])
    sizes = Sizes(good, bad)
    w = calibrate(np.array([sizes(cs) for _, cs in rest]), np.array([y for y, _ in rest], float))
    return good, bad, w.tolist()


def score_texts(docs: DataFrame, model: tuple[bytes, bytes, list[float]] | None, text: str = "text") -> DataFrame:
    """``docs`` with (quality_score, quality_predicted), which replace columns of their names."""
    if model is None:
        return docs.withColumns({"quality_score": F.lit(0.5), "quality_predicted": F.lit(1)})
    good, bad, w = model

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizes, coef = Sizes(good, bad), np.array(w)
        for batch in texts:
            x = np.array([sizes(chunks(t.encode())) for t in batch]).reshape(-1, 3)
            yield pd.Series(1 / (1 + np.exp(-np.clip(features(x) @ coef, -30, 30))))

    scored = docs.withColumn("quality_score", score(C.whole_text(text)))
    return scored.withColumn("quality_predicted", (F.col("quality_score") >= PREDICT_AT).cast("int"))


def op4_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, C.read(spark, sf_dir, "labels"))
    return score_texts(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
                                           F.col("quality_predicted").alias("predicted"))


QUERIES = {"op4_compression_classifier": op4_compression_classifier}
ORACLES: dict[str, str] = {}
