"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pytest

from record_loader.llm import chat, common, compression, decontaminate, jaccard, linededup, mixing, pages, rules, suffixes, tokens

from . import brute

#: extra columns with names that the operators use themselves
EXTRA = ("key", "id", "row", "size", "rank", "target", "_w", "_t", "_base", "label", "bucket", "mix_size", "did", "th", "line_count", "score", "h", "n")
SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)


def prose(rng, n):
    return " ".join(rng.choice("the of and stone river bright seven walks under green hill paper letter".split()) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    a, b, long = prose(rng, 120), prose(rng, 300), prose(rng, 30_000)
    near = a.split()
    near[60] = "changed"
    return [(0, a), (1, b), (2, None), (3, ""), (None, a), (4, " ".join(near)), (5, long), (6, long), (7, "one two"), (8, "one  two"),
            (9, "\n \n"), (10, a + "\n" + b[:400]), (11, "first line\nsecond line\n\nthird line"), (12, "x\nfirst line\nsecond line\ny\nthird line"),
            (13, "To " * 200), (14, "é" * 130 + b[:150]), (15, "Ü" + "é" * 130)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if k % 4 == 0 else f"s{k % 3}", *[f"x{k}"] * len(EXTRA)) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(docs, texts, none):
    rows = {r.doc_id: r for r in linededup.dedup_lines(docs).collect()}
    want = brute.line_repeats(texts)
    assert {i: r.line_kept_text for i, r in rows.items()} == want
    assert rows[12].line_removed == 2 and rows[12].line_runs == 1 and rows[12].row == "x13"
    assert linededup.dedup_lines(none).count() == 0


def test_line_dedup_longer_runs(spark):
    lines = [chr(97 + k) for k in range(12)]
    rows = [(0, "\n".join(lines)), (1, "\n".join(["q", *lines[2:7], "r", *lines[5:7], "s"])), (2, "\n".join(lines[3:6] * 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for run in (1, 2, 3, 4):
        assert {r.doc_id: r.line_kept_text for r in linededup.dedup_lines(df, run).collect()} == brute.line_repeats(rows, run)


def test_line_dedup_long_single_lines(spark):
    """Copies of one-line documents and long lines between other lines go, short ones stay."""
    rng = random.Random(2)
    long, ten, nine = prose(rng, 60), prose(rng, 10), prose(rng, 9)
    rows = [(0, long), (1, long), (2, f"a\n{long}\nb"), (3, f"c\n{ten}\nd\n{ten}\n{nine}"), (4, f"e\n{nine}\nf"), (5, ten), (6, nine), (7, f"{long}\n{long}\n{ten}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for run, words in ((2, 10), (3, 10), (2, 60), (2, 1)):
        got = {r.doc_id: r for r in linededup.dedup_lines(df, run, long_words=words).collect()}
        assert {i: r.line_kept_text for i, r in got.items()} == brute.line_repeats(rows, run, words)
    got = {r.doc_id: r for r in linededup.dedup_lines(df).collect()}
    assert (got[1].line_kept_text, got[2].line_kept_text, got[6].line_kept_text) == ("", "a\nb", nine)
    assert (got[7].line_removed, got[7].line_runs) == (3, 1) and (got[3].line_removed, got[3].line_runs) == (1, 1)


def test_jaccard(docs, texts, none):
    got = sorted(((r.id, r.class_id, r.n_links, r.copy_of) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got == sorted(((i, *x) for (i, _), x in zip(texts, brute.near_duplicates(texts), strict=True)), key=str)
    assert jaccard.near_duplicates(none).count() == 0
    assert jaccard.one_of_each(none).columns == none.columns


def test_jaccard_blocks_and_large_groups(spark, monkeypatch):
    """A group dealt out as many block pairs gives the same links."""
    rng = random.Random(1)
    base = prose(rng, 60).split()
    rows = []
    for i in range(70):
        w = list(base)
        for _ in range(rng.randrange(3)):
            w[rng.randrange(60)] = f"w{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: x for (i, _), x in zip(rows, brute.near_duplicates(rows), strict=True)}
    for size in (1024, 9):
        monkeypatch.setattr(jaccard, "BLOCK_TEXTS", size)
        assert {r.id: (r.class_id, r.n_links, r.copy_of) for r in jaccard.near_duplicates(df).collect()} == want


def test_one_document_of_each_group(spark, docs, texts):
    twice = docs.unionByName(docs)
    kept = jaccard.one_of_each(twice)
    assert kept.columns == docs.columns
    want = brute.near_duplicates(texts)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({x[0] for x in want})


@pytest.mark.parametrize("plain", [False, True])
def test_tokens(docs, texts, none, spark, plain):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.tokenizer_path())
    t.encode_special_tokens = plain
    odd = spark.createDataFrame([(20, "a\tb  c\r\n"), (21, "<|endoftext|> it's 'quoted'"), (22, "日本　語 x  \n y"), (22, "")], "doc_id long, text string")
    got = sorted(tokens.token_files(docs.select("doc_id", "text").union(odd), plain_specials=plain).collect(), key=lambda r: r.start)
    n = [len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x in sorted([*texts, *map(tuple, odd.collect())], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    assert [r.n_tokens for r in got if r.doc_id != 22] == [k for k, r in zip(n, got, strict=True) if r.doc_id != 22]
    assert sum(r.n_tokens for r in got) == sum(n) and [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert got[0].doc_id is None
    assert tokens.token_files(none).count() == 0


def test_tokens_of_one_doc_id_over_many_partitions(spark):
    """Ordered by the hash of their text, across partitions too."""
    df = spark.createDataFrame([(1, f"text {k} " + "word " * (k % 9)) for k in range(400)], "doc_id long, text string").repartition(8)
    t = tokens.encoder(tokens.tokenizer_path())
    got = sorted(tokens.token_files(df).collect(), key=lambda r: r.start)
    texts_in_order = [r.text for r in df.select("text", common.text_key(df["text"]).alias("k")).orderBy("k").collect()]
    assert [r.n_tokens for r in got] == [len(x) + 1 for x in t(texts_in_order)]


def test_directly_addressable_codes():
    rng = np.random.default_rng(3)
    for ids in (rng.integers(0, 50257, 5000), rng.integers(0, 200, 700), np.array([0, 255, 256, 2**32 - 1, 65536]), np.array([], int)):
        seg = tokens.Segment(tokens.pack(ids.astype(np.uint32)))
        assert len(seg) == len(ids) and [seg[i] for i in range(len(ids))] == ids.tolist()
        for a in range(0, len(ids), 97):
            assert seg.slice(a, min(len(ids), a + 513)).tolist() == ids[a:a + 513].tolist()


def test_compression(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i not in (13,)), None) for i in range(16)], "doc_id long, quality int, toxic int")
    model = compression.learn(docs, labels)
    assert model is not None
    out = compression.score_texts(docs, model)
    assert out.count() == docs.count() and set(docs.columns) < set(out.columns)
    assert out.where("quality_score IS NULL OR quality_score < 0 OR quality_score > 1").isEmpty()
    assert compression.score_texts(none, model).count() == 0
    assert compression.learn(none, labels) is None
    assert compression.score_texts(docs, None).where("quality_predicted = 1").count() == docs.count()


def test_pages(spark):
    foot = "one two three four five six seven eight nine ten"
    rows = [(i, f"http://h/{i}", f"<body><div>{foot}</div><div>only page number {i} has this</div><p>Menu</p><nav>a</nav>", "x") for i in range(4)]
    copy = (9, "http://k/1", f"<body><div>{foot}</div>", "x")
    odd = [(None, None, None, None), copy, copy, (10, "http://m/", "<article><h1>T &amp; U</h1>a<b>b</b> c<script>if(a<b)</script><aside>no</aside>"
            "<section class='user-comments'><article>c</article></section><p>z<p>" + "w " * 40_000 + "</article><form>f</form>", "x"), (11, "http://n/", "", "x")]
    df = spark.createDataFrame(rows + odd, "page_id long, url string, html string, zones string")
    got = sorted((r.id or "", r.text) for r in pages.main_text(df).collect())
    want = [("", ""), ("10", "T & U\nab c\nz\n" + " ".join(["w"] * 40_000)), ("11", ""), ("9", foot), ("9", foot)]
    assert got == sorted([*want, *[(str(i), f"only page number {i} has this") for i in range(4)]])
    assert pages.main_text(df.limit(0)).count() == 0


def test_pages_keep_what_few_articles_share(spark):
    """A footer on all articles goes; copies beside other adverts, quotations and phrases stay whole."""
    rng = random.Random(3)
    foot, phrase, quote = prose(rng, 15), prose(rng, 9), prose(rng, 60)
    same = [prose(rng, 90), prose(rng, 25)]
    own = [[prose(rng, 50), prose(rng, 10) + " " + phrase + " " + prose(rng, 10)] for _ in range(8)]
    bodies = {i: [*same, f"advert number {i} of the day for you"] for i in range(4)}
    bodies |= {10 + i: [*a, *([quote] if i < 2 else [])] for i, a in enumerate(own)}
    page = "<div>{}</div>".format
    rows = [(i, f"http://h/{i}", "".join(map(page, [*b, foot]))) for i, b in bodies.items()]
    # nothing but copies of one article on the host, and two pages only
    alone = {20 + i: ["k", [same[0], f"advert number {i} of the day", foot]] for i in range(4)} | {30 + i: ["m", [same[0], f"date {i}"]] for i in range(2)}
    rows += [(i, f"http://{h}/{i}", "".join(map(page, b))) for i, (h, b) in alone.items()]
    df = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string").repartition(3)
    got = {(r.id, r.text) for r in pages.main_text(df).collect()}
    assert got == {(str(i), "\n".join(b)) for i, b in bodies.items()} | {(str(i), "\n".join(b)) for i, (_, b) in alone.items()}


@pytest.mark.parametrize("html, want", [
    ("<div class='layout with-sidebar'><article>text</article></div>", "text"),
    ("<main class='no-sidebar'>text</main><div class='site-footer'>f</div>", "text"),
    ("<div id='page-header-fixed'><p>text</p></div>", "text"),
    ("<div class='sidebar'>menu<article>text</article></div>", "text"),
    ("<div id='search'><main>text</main></div>", "text"),
    ("<article>text</article><div class='sidebar'><article>teaser</article></div>", "text"),
    ("<p>text</p><div id='comments'><article class='body'>reply</article></div>", "text"),
    ("<p>text</p><div class='ad-slot'>buy</div><div class='site__footer--wide'>f</div>", "text"),
    ("<form id='aspnet'><input><div>lead</div><article>text</article></form>", "lead\ntext"),
    ("<form><nav>m</nav><div>text</div></form><form>mail</form>", "text"),
    ("<article><h2 id='related-work'>A</h2><section id='search'>b</section><h3 id='notice'>c</h3><section id='search-methods'>d</section></article>", "A\nb\nc\nd"),
    ("<article>text<form>mail</form><div id='related'>other</div><section class='user-comments'>c</section><div data-id='share'>d</div></article>", "text\nd")])
def test_page_zones_by_name(html, want):
    kept = [t for z, t in pages.blocks(f"<html><body class='sidebar'>{html}</body></html>") if z in (pages.OPEN, pages.IN_MAIN)]
    assert "\n".join(kept) == want


def test_mixing(docs, texts, none):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(texts) and set(docs.columns) < set(rows[0].asDict())
    by = {}
    for r in rows:
        assert r.mix_size == len(brute.words(r.text)) and 0 <= r.mix_copies <= 3 and r.row.startswith("x")
        by.setdefault(r.source, []).append(r)
    total = sum(r.mix_size for r in rows)
    assert sum(r.mix_size * r.mix_copies for r in rows) <= total
    for part in by.values():
        assert part[0].mix_source_size == sum(r.mix_size for r in part)
        assert abs(sum(r.mix_size * r.mix_copies for r in part) - part[0].mix_target) <= max(r.mix_size for r in part)
    assert sorted(map(str, mixing.mix_sources(docs.repartition(7)).collect())) == sorted(map(str, rows))
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mix_sources(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixing_targets(spark):
    """Targets stop at three times the source; the excess is shared again."""
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 400), ("d", 0), (None, 100)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    caps, w = {"a": 30, "b": 3000, "c": 1200, "d": 0, None: 300}, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    left, open_, want = 1510.0, set(caps), {}
    while open_:
        over = [s for s in open_ if left * w[s] / sum(w[x] for x in open_) > caps[s]]
        if not over:
            want |= {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
            break
        for s in over:
            want[s] = caps[s]
            open_.discard(s)
        left = 1510.0 - sum(want.values())
    assert got == pytest.approx(want)


def test_suffixes(docs, texts, none):
    got = {r.did: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(docs).collect()}
    assert got == brute.cut_repeats(texts)
    assert suffixes.remove_repeats(none).count() == 0


@pytest.mark.parametrize("parts", [1, 29])
def test_suffixes_across_boundaries(spark, parts):
    rng = random.Random(parts)
    base = ["".join(rng.choice("ab c") for _ in range(400)) for _ in range(3)]
    rows = [(0, base[0]), (1, "x" * 350), (2, base[2] + base[2] + base[2][:120]), (3, base[0][:99])]
    for k in range(4, 60):
        b, a = rng.choice(base), rng.randrange(300)
        rows.append((k, "".join(rng.choice("abé") for _ in range(rng.randrange(40))) + b[a:a + rng.randrange(80, 300)] + "".join(rng.choice("ab") for _ in range(60))))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.did: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.cut_repeats(rows)


@pytest.mark.parametrize("first", [0, None])
def test_suffixes_of_repeated_rows(spark, first):
    """A repeated row is one document: it loses nothing to itself where another document shares part of it."""
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(700))
    rows = [(first, "1" * 20 + base[:400] + "2" * 30), (1, base[150:600] + "3" * 40), (2, "4" * 25 + base[350:])]
    df = spark.createDataFrame([*rows, rows[0], rows[1], rows[1]], "doc_id long, text string").repartition(3)
    got = [(r.did, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffixes.remove_repeats(df).collect()]
    want = brute.cut_repeats(rows)
    assert sorted(got, key=str) == sorted([(i, want[i]) for i in (first, 1, 2, first, 1, 1)], key=str)
    assert want[first][1] == 0 and want[1][1] and want[2][1]


def test_rules(docs, texts, none):
    rows = rules.score_quality(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {str(r.row.doc_id): tuple(r._base[n] for n in names) for r in rows} == {str(i): brute.base_counts(t) for i, t in texts}
    assert all(r._failed for r in rows if r.row.doc_id in (2, 3, 7, 9, 13))
    assert rules.kept_documents(docs).columns == docs.columns
    assert rules.score_quality(none).count() == 0


def test_rule_estimate_matches_a_plain_one():
    counts = [((1, 1, 1), 800), ((-1, 1, 1), 60), ((1, -1, -1), 70), ((0, 1, 1), 50), ((-1, -1, 0), 20)]
    share, rates = rules.estimate(counts)
    p = {v: rules.posterior(v, share, rates) for v, _ in counts}
    assert p[1, 1, 1] > 0.95 and p[1, -1, -1] < 0.5
    good = sum(p[v] * n for v, n in counts)
    assert share == pytest.approx((good + 1) / 1002, abs=1e-3)
    for j, r in enumerate(rates):
        assert sum(x[0] for x in r.values()) == pytest.approx(1) and sum(x[1] for x in r.values()) == pytest.approx(1)
        assert r[-1][1] == pytest.approx((sum((1 - p[v]) * n for v, n in counts if v[j] == -1) + 1) / (1000 - good + 3), abs=1e-2)


def test_chat(spark):
    rows = [(1, 0, "user", "hi </s> <\\/s> [INST]", 1), (1, 1, "assistant", None, 2), (1, 1, "assistant", "b<|im_end|>\n<", 3), (1, 1, "assistant", "b<|im_end|>\n<", 3),
            (None, None, None, None, 4), (2, 5, "assis%0A\ntant", "x", 5), *[(3, k, "assistant", f"t{k}", 6) for k in range(70)]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, id int")
    done = chat.format_trees(chat.as_tree(df))
    from pyspark.sql import functions as F
    got = {r.tree: r for r in done.select("tree", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    plain = {"1": rows[:4], "null": rows[4:5], "2": rows[5:6], "3": rows[6:]}
    for k, part in plain.items():
        part = sorted(part, key=lambda r: (r[1] or 0, r[2] or "", r[3] or ""))
        assert [tuple(t) for t in got[k].turns] == [(r[2] or "", r[3] or "") for r in part]
        assert got[k].loss == "".join(r[3] or "" for r in part if r[2] == "assistant")
        assert "</s>" not in got[k].formatted and "[INST]" not in got[k].formatted and got[k].formatted.count("<|im_end|>") == len(part)
    assert chat.format_trees(chat.as_tree(df.limit(0))).count() == 0


def test_reply_trees(spark):
    """Branches are paths of their own, ranked by mean score; orphans are roots, cycles are left out."""
    m = [("t", 1, None, 1.0), ("t", 2, 1, 0.0), ("t", 3, 1, 4.0), ("t", 4, 2, 9.0), ("t", 5, 3, 1.0), ("u", 7, 99, 1.0), ("u", 8, 9, 1.0), ("u", 9, 8, 1.0)]
    df = spark.createDataFrame([(*x, "user", f"m{x[1]}") for x in m], "tree string, id long, parent long, score double, role string, text string")
    paths = {}
    for r in chat.reply_paths(df).collect():
        paths.setdefault((r.tree, r.leaf), {})[r.up] = r.id
    assert {k: [v[i] for i in sorted(v, reverse=True)] for k, v in paths.items()} == {("t", 4): [1, 2, 4], ("t", 5): [1, 3, 5], ("u", 7): [7]}
    assert {(r.tree, r.leaf) for r in chat.reply_paths(df, top=1).collect()} == {("t", 4), ("u", 7)}


def test_decontamination(spark, docs, texts, none):
    item = " ".join(texts[1][1].split()[40:70])
    some = item.split()
    some[0] = "other"
    items = [(1, item), (2, " ".join(some)), (3, None), (4, "one two"), (None, " ".join(texts[5 + 1][1].split()[:200])), (5, "not in any of them at all here"), (1, item)]
    df = spark.createDataFrame([(*x, "k") for x in items], "item_id long, text string, key string")
    got = sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_item) for r in decontaminate.find_items(docs, df).collect())
    want = sorted((str(d), str(i), *n) for (d, _, i, _), n in brute.contained(texts, items).items())
    assert got == want and want
    assert got == sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_item) for r in decontaminate.find_items(docs, df, max_sketch=None).collect())
    # items of a few words are found in long documents, but only those that are that very text are removed for them
    w = texts[1][1].split()
    few = [(k, " ".join(w[20:20 + k])) for k in (1, 2, 3, 4)] + [(5, w[3]), (6, "nowhere seen"), (7, "")]
    some = spark.createDataFrame(few, "item_id long, text string")
    got = sorted((str(r.doc_id), str(r.item_id), r.n_shared, r.n_item) for r in decontaminate.find_items(docs, some).collect())
    assert got == sorted((str(d), str(i), *n) for (d, _, i, _), n in brute.contained(texts, few).items())
    assert {i for d, i, *_ in got if d == str(texts[1][0])} >= {"1", "2", "3", "4", "5"}
    exact = brute.contained(texts, few, short=False)
    assert decontaminate.decontaminated(docs, some).count() == len([t for t in texts if not any(d == t[0] for d, *_ in exact)])
    bad = {str(d) for d, *_ in brute.contained(texts, items, short=False)}
    clean = decontaminate.decontaminated(docs, df)
    assert clean.columns == docs.columns and {str(r.doc_id) for r in clean.collect()} == {str(i) for i, _ in texts} - bad
    assert decontaminate.find_items(none, df).count() == 0 and decontaminate.find_items(docs, df.limit(0)).count() == 0
    assert decontaminate.decontaminated(docs, df.limit(0)).count() == len(texts)
