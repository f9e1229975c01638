"""SimHash links, fill-in-the-middle and cross-tokenizer alignment against plain versions."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as E
from record_loader.llm import alignment, fillmiddle, simhash

from ..conftest import SF_SMALL
from . import brute

EXTRA = ("id", "fp", "row", "tab", "part", "body", "at", "fim_text", "pair", "n", "same", "units")
SCHEMA = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in EXTRA)


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def odd_texts():
    rng = random.Random(3)
    words = "river stone paper Green hill walks bright seven letters under".split()
    long = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(40_000))
    return [(0, "one two three four"), (1, "ONE two three Four"), (2, None), (3, ""), (None, "one two three four"), (4, "\t\n \x0b"), (5, "é À one"), (5, "é À one"),
            (6, long), (7, long + " more"), (8, "a"), (9, "a b"), (10, "line\n\nnext line\r\n  third\n"), (11, "x <P> y"), (12, "a<S"), (13, ">tail\n<\nM>"),
            (14, "　wide  space   end"), (15, "<|endoftext|> </s> <0x41>"), (16, "low ▁ line"), (17, "nul \x00 byte"), (18, "\U0001F600 smile   three spaces"),
            (19, "don't we'll 12345 ... !!!\n\n\n  x"), (20, " lead"), (21, "trail "), (22, "\n"), (23, "日本語 の テキスト、です。")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, *[f"x{k}"] * len(EXTRA)) for k, (i, t) in enumerate(rows)], SCHEMA).repartition(3)


# ---- SimHash ----

def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius=3):
    top = list(range(len(fps)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    values = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= radius) + i + 1:
            top[find(int(j))] = find(i)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(ids))]


def check_simhash(rows, got):
    fps = [plain_fingerprint(t) for _, t in rows]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, plain_components([i for i, _ in rows], fps), strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_op11(spark, docs):
    rows = E.queries()["op11_simhash"](spark, SF_SMALL)
    assert rows.columns == ["doc_id", "fingerprint", "component_id"]
    check_simhash(docs, [tuple(r) for r in rows.collect()])


def test_simhash_odd_texts(spark):
    rows = odd_texts()
    got = simhash.near_duplicates(frame(spark, rows)).select("id", simhash.hex_of("fp"), "component_id")
    check_simhash(rows, [tuple(r) for r in got.collect()])
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        assert any(not m & sum(1 << b for b in bits) for m in masks)
    levels = simhash.mask_levels()
    assert max(64 - m.bit_count() for _, _, m in levels[-1]) <= 8
    for level, above in zip(levels[1:], levels, strict=False):
        table = {t: m for _, t, m in above}
        by = collections.defaultdict(list)
        for parent, _, m in level:
            assert m & table[parent] == table[parent]
            by[parent].append(m)
        parent = next(iter(by))
        hidden = [b for b in range(64) if not table[parent] >> b & 1]
        for bits in itertools.combinations(hidden, 3):
            assert any(not m & sum(1 << b for b in bits) for m in by[parent])


@pytest.mark.parametrize("bucket", [2, 256])
def test_simhash_links_of_crowded_fingerprints(spark, bucket):
    """Many fingerprints in one ball: large buckets are split by further families, and no link is lost."""
    rng = random.Random(bucket)
    centre = rng.getrandbits(64)
    fps = {centre} | {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 7))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    edges = simhash.linked_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=bucket).collect()
    top = {f: f for f in signed}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for e in edges:
        top[find(e.a)] = find(e.b)
    groups = collections.defaultdict(set)
    for f in signed:
        groups[find(f)].add(f)
    want = collections.defaultdict(set)
    for f, c in zip(signed, plain_components(list(range(len(signed))), [f & (2**64 - 1) for f in signed]), strict=True):
        want[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_simhash_buckets_stay_whole_under_adaptive_execution(spark):
    """Members of a bucket meet in one task where Spark splits the partitions of the join before."""
    rng = random.Random(11)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(40):  # groups within the radius of their centre
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(12)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    rng.shuffle(signed)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1b"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        edges = simhash.linked_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long").repartition(8)).collect()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    plain = [f & (2**64 - 1) for f in signed]
    want = plain_components(list(range(len(signed))), plain)
    at, top = {f: k for k, f in enumerate(signed)}, list(range(len(signed)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for e in edges:
        a, b = sorted((find(at[e.a]), find(at[e.b])))
        top[b] = a
    assert [find(k) for k in range(len(signed))] == want
    assert len(set(want)) < len(want) / 2


# ---- fill-in-the-middle ----

def plain_fim(doc_id, text, seed=7, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return text, "plain", len(units), None, None
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return f"<S>{s}<P>{p}<M>{m}", "spm", len(units), len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", len(units), len(p), len(m)


@pytest.mark.parametrize("args", [{}, {"seed": 1, "fim_percent": 50, "spm_percent": 20}])
def test_fill_in_middle(spark, docs, args):
    rows = odd_texts() + docs + [(1000 + k, "l\n" * k + "é" * 700 * (k % 3) + "\nend" * (k % 2)) for k in range(60)]
    made = fillmiddle.fill_in_middle(frame(spark, rows), **args)
    got = made.select("doc_id", "text", "fim_text", "fim_form", "fim_units", "fim_prefix_chars", "fim_middle_chars", fillmiddle.restored().alias("back"), "row").collect()
    assert len(got) == len(rows) and all(r.row.startswith("x") for r in got)
    for r in got:
        assert (r.fim_text, r.fim_form, r.fim_units, r.fim_prefix_chars, r.fim_middle_chars) == \
            plain_fim(r.doc_id, r.text, args.get("seed", 7), args.get("fim_percent", 100), args.get("spm_percent", 50))
        assert r.back == (r.text or "")
    assert fillmiddle.fill_in_middle(frame(spark, rows).limit(0)).count() == 0


def test_fill_in_middle_sentinels_across_chunks(spark, monkeypatch):
    """With chunks of a byte or two every sentinel crosses borders."""
    monkeypatch.setattr(fillmiddle, "CHUNK_BITS", 0)
    monkeypatch.setattr(fillmiddle, "WINDOW", 1)
    import pyarrow as pa

    texts = ["a<P>b", "<S", "x<", "<M>", "a\nb<\nS>c\n", "p<S>", "", "\n\n"]
    run = fillmiddle._places(7, 100, 50, fillmiddle.Sentinels())
    fillmiddle._MEMOS.clear()
    for i, r in enumerate(run(pa.array(range(len(texts))), pa.array(texts)).to_pylist()):
        want = plain_fim(i, texts[i])
        assert (r["form"], r["units"], r["prefix_end"]) == (want[1], want[2], want[3])
    fillmiddle._MEMOS.clear()


def test_chunk_memo_is_used_and_verified():
    import pyarrow as pa

    fillmiddle._MEMOS.clear()
    rng = random.Random(5)
    shared = " ".join(str(rng.random()) for _ in range(3000))
    run = fillmiddle._places(7, 100, 50, fillmiddle.Sentinels())
    run(pa.array([1, 2, 3]), pa.array([shared, "new start " + shared, shared[777:] + "\n"]))
    memo = fillmiddle._MEMOS[fillmiddle.Sentinels()]
    assert memo.hits > 1.8 * memo.misses
    made = memo.summary(next(iter(memo.known)), b"other bytes\n<P>")
    assert made[1:4] == (1, 15, True)  # a chunk of the same hash but other bytes is not taken for it
    fillmiddle._MEMOS.clear()


def test_sentinels_must_not_overlap():
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("aXa", "b", "c"), ("<P>", "P", "<M>")):
        with pytest.raises(ValueError):
            fillmiddle.Sentinels(*bad)


def test_fill_in_middle_runs_python_once(spark):
    plan = E.queries()["op12_fill_in_middle"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


# ---- cross-tokenizer alignment ----

def plain_alignment(rows):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(P.path("byte_bpe_50k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    of = alignment.byte_alphabet()
    made = []
    for i, t in rows:
        whole = (" " + (t or "")).encode()
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids if t else [], b.encode(t) if t else []
        xs = [bytes(of[c] for c in a.id_to_token(x)) for x in ids_a]
        ys = [bytes([int(b.id_to_piece(y)[3:5], 16)]) if b.is_byte(y) else b.id_to_piece(y).replace("▁", " ").encode() for y in ids_b]
        if not t or b"".join(xs) != whole or b"".join(ys) != whole:
            made.append((i, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in xs]).tolist(), np.cumsum([len(y) for y in ys]).tolist()
        at_a, at_b = {e: k for k, e in enumerate(ends_a)}, {e: k for k, e in enumerate(ends_b)}
        both = [e for e in ends_a if e in at_b]
        links = [(ids_a[at_a[e]], ids_b[at_b[e]]) for e in both]
        parts, p, q = [], 0, 0
        for e in both:
            parts.append(",".join(map(str, ids_a[p:at_a[e] + 1])) + "|" + ",".join(map(str, ids_b[q:at_b[e] + 1])))
            p, q = at_a[e] + 1, at_b[e] + 1
        made.append((i, len(ids_a), len(ids_b), len(both), links, hashlib.sha256(";".join(parts).encode()).hexdigest()))
    count = collections.Counter(x for m in made for x in m[4])
    most = collections.Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return count, [(i, na, nb, ng, len(ls), sum(count[x] == most[x[1]] for x in ls), sum(count[x] for x in ls), sha) for i, na, nb, ng, ls, sha in made]


def test_op13(spark, docs):
    got = E.queries()["op13_cross_tokenizer"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_alignment(docs)[1])


@pytest.mark.parametrize("hot", [1, 100, 65_536])
def test_alignment_odd_texts_and_pair_shuffle(spark, hot):
    """``hot`` of 1: all irregular links go through the shuffle."""
    rng = random.Random(hot)
    parts = ["a", " ", "  ", "\n", "é", "don't", "▁", " ", "　", "日本", "...", "123", "<s>", "<|endoftext|>", "\t", "\r\n", "ß", "Ωmega", "word", "\x1c", "\x85", " "]
    rows = odd_texts() + [(100 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))) for k in range(300)]
    count, want = plain_alignment(rows)
    out, pairs = alignment.align(frame(spark, rows), hot_share=hot)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)
    none, nothing = alignment.align(frame(spark, rows).limit(0), hot_share=hot)
    assert none.count() == nothing.count() == 0


def test_words_of_fingerprints_are_the_contract_s(docs):
    for _, t in docs[:50]:
        assert len(simhash.shingle_hashes(t or "")) == max(len(brute.words(t)) - 2, 1 if brute.words(t) else 0)


# ---- broken markup ----

@pytest.mark.parametrize("html, want", [
    ("<article><p title=it's>one two</p><p>three's four</p></article>", "one two|three's four"),
    ('<article><p class="a>one</p><p>two</p></article>', "one|two"),
    ('<article><p class="a>one</p><p>the 5" pipe</p></article>', 'one|the 5" pipe'),
    ("<article><p title=\"a > b\">one</p><p data-x='<b>x</b>'>two</p></article>", "one|two"),
    ('<div class="post-header"><h1>Title</h1></div><article>body</article>', "Title|body"),
    ('<div class="site-header">Site</div><article>body</article>', "body"),
    ("<article>a < b <b>bold</b> 3<4</article>", "a < b bold 3<4"),
    ("<article><p <b>bold</b> x</article>", "bold x"),
    ("<article>one</p></div></span> two</article>", "one two"),
    ("<article><div aria-hidden=true>no</div><div style='display : none'>no</div><div hidden>no</div>yes<!-- <p>no --></article>", "yes")])
def test_broken_markup_keeps_the_article(html, want):
    from record_loader.llm import pages

    assert "|".join(t for z, t in pages.blocks(html) if z in (pages.OPEN, pages.IN_MAIN)) == want


@pytest.mark.parametrize("unit", ['<a x="', "<b c='", '<p class="a>', "<p x='y z>", "</z>", "<div>", "<b>", "<", "<!", "<form><nav>", "<a   ", "<b><p>", "<li><b>"])
def test_broken_markup_takes_linear_time(unit):
    import time

    from record_loader.llm import pages

    def seconds(size):
        page, start = unit * (size // len(unit)), time.process_time()
        pages.blocks(page)
        return time.process_time() - start

    small = min(seconds(100_000) for _ in range(2))
    assert seconds(1_600_000) < 16 * 4 * max(small, 0.02)  # quadratic time would be 256 times


# ---- compression classifier, against a plain loop ----

def test_op4_scores(spark, docs):
    """The query's scores from the same dictionaries and coefficients, text by text."""
    import math
    import zlib

    import zstandard

    from record_loader.llm import compression

    frame_ = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    good, bad, w = compression.learn(frame_, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    got = {r.doc_id: r for r in E.queries()["op4_compression_classifier"](spark, SF_SMALL).collect()}

    def size(piece, data):
        c = zstandard.ZstdCompressor(level=compression.LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(c.compress(piece)) - len(c.compress(b""))

    for i, t in docs[::4]:
        raw = (t or "").encode()
        parts = [raw[k:k + compression.CHUNK] for k in range(0, len(raw), compression.CHUNK)]
        g, b = (sum(size(p, data) for p in parts) for data in (good, bad))
        d, per, n = ((b - g) / max(g, b, 1), g / len(raw), math.log1p(len(raw))) if raw else (0.0, 0.0, 0.0)
        score = 1 / (1 + math.exp(-max(-30, min(30, sum(x * y for x, y in zip(w, (1, d, per, per * per, n, d * n), strict=True))))))
        r = got[i]
        assert abs(r.score - score) < 1e-9 and r.predicted == int(score >= 0.3) and r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
