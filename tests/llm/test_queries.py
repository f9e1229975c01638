"""The operators' queries on the smallest tables: against their SQL, or a plain version."""

import html
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from check_queries import TABLES, canon
from record_loader.llm import compression, registry, tokens

from ..conftest import SF_CHECK, SF_SMALL
from . import brute


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    names = [k for k in E.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(registry.oracles()))
def test_query_matches_its_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(registry.oracles()[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert canon(rows, cols) == canon(orows, ocols)


def test_op2(spark, docs):
    got = {r.doc_id: (r.class_id, r.n_links, r.copy_of) for r in E.queries()["op2_ngram_jaccard"](spark, SF_SMALL).collect()}
    assert got == {i: x for (i, _), x in zip(docs, brute.near_duplicates(docs), strict=True)}


def test_op3(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in E.queries()["op3_token_files"](spark, SF_SMALL).collect()}
    start = 0
    for i, text in sorted(docs):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op4_on_documents_it_has_not_learnt(spark):
    got = compression.op4_compression_classifier(spark, SF_CHECK).join(spark.read.parquet(f"{SF_CHECK}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    pairs = [(a.score, b.score) for a in held if a.quality for b in held if not b.quality]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.9


def test_op5(spark):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in E.queries()["op5_html_extraction"](spark, SF_SMALL).collect()}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(p for p in parts if p)
        assert got[r.page_id] == (r.url, text, len(text))


def test_op7(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in E.queries()["op7_suffix_dedup"](spark, SF_SMALL).collect()}
    assert got == brute.cut_repeats(docs)


def test_op8(spark, docs):
    rows = E.queries()["op8_quality_rules"](spark, SF_CHECK).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in rows if not r.base_failed}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    known = [(kept[i], label[i]) for i in kept if i in label]
    assert sum(k == bool(q) for k, q in known) >= 0.97 * len(known)
