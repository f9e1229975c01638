"""The pipeline's stages on the smallest tables, each against a plain version on its own input."""

import random
import zlib

import numpy as np

import corpus_pipeline
from record_loader.llm import common, rules, tokens

from ..conftest import SF_SMALL
from . import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.written(stage(spark, docs, SF_SMALL), f"test-{name}")
        seen[name] = ([(r.doc_id, r.text) for r in docs.collect()], out.collect())
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            docs = out
    before, after = seen["quality_rules"]
    judged = {r.row.doc_id: r._kept for r in rules.score_quality(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()}
    assert {r.doc_id for r in after} == {i for i, _ in before if judged[i]}
    before, after = seen["ngram_jaccard"]
    assert sorted(r.doc_id for r in after) == sorted({x[0] for x in brute.near_duplicates(before)})
    before, after = seen["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    bad = {d for d, *_ in brute.contained(before, items)}
    assert bad and {r.doc_id for r in after} == {i for i, _ in before} - bad
    before, after = seen["mixing"]
    assert sum(len(brute.words(r.text)) for r in after) <= sum(len(brute.words(t)) for _, t in before)
    assert {r.doc_id for r in after} <= {i for i, _ in before}
    before, after = seen["token_files"]
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    start, want = 0, []
    for i, text in sorted(before):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in after) == sorted(want)
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(want)


def test_odd_documents(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, clashing columns, empty tables."""
    rng = random.Random(4)
    word = lambda: rng.choice("river stone paper green hill walks bright seven letters under".split()) + str(rng.randrange(900))
    texts = [" ".join(word() for _ in range(200)) for _ in range(6)]
    long = " ".join(word() for _ in range(30_000))
    rows = [(0, texts[0], "en", "a"), (0, texts[0], "en", "a"), (1, texts[0], None, "b"), (2, None, None, None), (None, texts[1], "en", None), (3, "", "en", "a"),
            (4, long, "de", "a"), (5, texts[2], "en", "b"), (6, texts[3], "en", None), (7, texts[4] + " shared item " + texts[5], "en", "c")]
    extra = ("key", "row", "size", "_w", "label", "n_tokens")
    docs = spark.createDataFrame([(*r, 0, *["x"] * len(extra)) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    items = spark.createDataFrame([(0, texts[5]), (1, None), (2, "")], "item_id long, text string")
    folder = str(tmp_path)
    items.write.parquet(f"{folder}/benchmark.parquet")
    docs.limit(0).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
    out = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.written(stage(spark, out, folder), "odd")
        if k < 4:
            assert out.columns == docs.columns and all(r.row == "x" for r in out.collect())
        if k == 1:
            assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([0, None, 4, 5, 6, 7], key=str)
        if k == 2:
            assert 7 not in {r.doc_id for r in out.collect()}
    assert {r.doc_id for r in out.collect()} <= {0, None, 4, 5, 6}
    assert sorted(r.start for r in out.collect()) == list(np.cumsum([0, *[r.n_tokens for r in sorted(out.collect(), key=lambda r: r.start)]])[:-1])
