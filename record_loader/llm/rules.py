"""Quality rules under weak supervision: every rule votes good, bad or abstains; expectation
maximisation over the counts of vote patterns estimates how reliable each rule is; a document is
kept by its posterior probability of being good, not by passing every rule.

Base columns and votes are column expressions. The corpus enters the estimate as one count per
vote pattern (at most 3 ** 7 = 2,187 patterns whatever the input, summed map-side), the estimate
is arithmetic on those counts, and the posterior is again an expression: a weight per vote.

Repeated 3-word windows of a text are found inside its row: window hashes with their place are
sorted, equal neighbours are marked, and the words that marked places cover are summed.

Defined cases: null and empty texts have no words and fail the base rule; texts of one or two
words have no window; an empty table gives no rows (and no estimate is needed); repeated rows
are judged alike; other columns, whatever their names, are carried untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50  # percent

#: Upper-case letters counted by the rule on capitals (ASCII and the Latin-1 capitals).
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"

KEEP_AT = 0.5
ITERATIONS = 60


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeat_words() -> str:
    """Words covered by 3-word windows whose hash occurs at least twice in the row's word list ``_w``."""
    windows = "transform(sequence(0, size(_w) - 3), i -> struct(xxhash64(_w[i], _w[i + 1], _w[i + 2]) AS h, i AS at))"
    return f"CASE WHEN size(_w) < 4 THEN array() ELSE sort_array({windows}) END"


_MARKED = ("sort_array(filter(transform(_s, (x, i) -> CASE WHEN (i > 0 AND _s[i - 1].h = x.h) "
           "OR (i < size(_s) - 1 AND _s[i + 1].h = x.h) THEN x.at END), x -> x IS NOT NULL))")
_COVERED = ("aggregate(_m, named_struct('last', -3, 'n', 0), (a, p) -> "
            "named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n)")


def base_columns(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, _base, _failed): the columns of ``docs`` as a struct, and a struct of counts (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_capitals, n_marks)."""
    body = C.whole_text(text)
    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(C.SPACE_CHARS)) != "")
    long = lambda c: c.cast("long")
    d = docs.select(C.row_of(docs), body.alias("_t"))
    body = F.col("_t")
    d = d.withColumns({"_w": C.words(body), "_l": lines})
    d = d.withColumn("_s", F.expr(_repeat_words())).withColumn("_m", F.expr(_MARKED))
    # one element, exploded: what reads the counts is not folded into working them out
    d = d.withColumn("_base", F.explode(F.array(F.struct(
        long(F.size("_w")).alias("n_words"),
        long(F.length(F.translate(body, C.SPACE_CHARS, ""))).alias("word_chars"),
        long(_without(body, SYMBOLS)).alias("n_symbols"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        long(F.expr(_COVERED)).alias("n_repeat_words"),
        long(F.size("_l")).alias("n_lines"),
        long(_without(body, CAPITALS)).alias("n_capitals"),
        long(_without(body, "!?")).alias("n_marks")))))
    failed = (F.col("_base.n_words") < MIN_WORDS) | (100 * F.col("_base.n_repeat_words") > MAX_REPEAT_SHARE * F.col("_base.n_words"))
    return d.select("row", "_base", failed.alias("_failed"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over ``_base``: 1 good, -1 bad, 0 abstains."""
    b = lambda k: F.col(f"_base.{k}")
    n = F.greatest(b("n_words"), F.lit(1))
    chars = F.greatest(b("word_chars"), F.lit(1))
    return {
        "repeats": _vote(100 * b("n_repeat_words") > 30 * n, 100 * b("n_repeat_words") < 15 * n),
        "symbols": _vote(100 * b("n_symbols") > 10 * n, 100 * b("n_symbols") < 2 * n),
        "symbol_share": _vote(100 * b("n_symbols") > 4 * chars, 100 * b("n_symbols") < chars),
        "capitals": _vote(100 * b("n_capitals") > 30 * chars, 100 * b("n_capitals") < 15 * chars),
        "marks": _vote(100 * b("n_marks") > 20 * n, 100 * b("n_marks") < 5 * n),
        "dup_lines": _vote(100 * b("n_dup_lines") > 30 * F.greatest(b("n_lines"), F.lit(1)), b("n_dup_lines") == 0),
        "word_length": _vote((chars < 2 * n) | (chars > 14 * n), (chars >= 3 * n) & (chars <= 10 * n)),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], iterations: int = ITERATIONS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation maximisation over (vote pattern, count) of the documents that pass the base
    rule: the share of good documents and, per rule, how often good and bad documents get each
    vote, abstentions included: {vote: (on good, on bad)}. It starts from the belief that an
    objection makes a document bad, which names the two classes; rates are smoothed by one count."""
    patterns = sorted(patterns)
    total = sum(n for _, n in patterns)
    belief = [0.1 if -1 in v else 0.9 for v, _ in patterns]
    share, rates = 0.5, []
    for _ in range(iterations if total else 0):
        good = sum(p * n for p, (_, n) in zip(belief, patterns, strict=True))
        share = (good + 1) / (total + 2)
        rates = []
        for j in range(len(patterns[0][0])):
            seen = {v: [sum(b * n for b, (w, n) in zip(side, patterns, strict=True) if w[j] == v)
                        for side in (belief, [1 - b for b in belief])] for v in (1, 0, -1)}
            rates.append({v: ((on_good + 1) / (good + 3), (on_bad + 1) / (total - good + 3)) for v, (on_good, on_bad) in seen.items()})
        belief = [posterior(v, share, rates) for v, _ in patterns]
    return share, rates


def weights(share: float, rates: list[dict[int, tuple[float, float]]]) -> tuple[float, list[dict[int, float]]]:
    """Log odds of good: the constant, and per rule what each vote adds."""
    return math.log(share / (1 - share)), [{v: math.log(g / b) for v, (g, b) in r.items()} for r in rates]


def posterior(vote: tuple[int, ...], share: float, rates: list[dict[int, tuple[float, float]]]) -> float:
    base, w = weights(share, rates)
    odds = base + sum(w[j][v] for j, v in enumerate(vote))
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, odds))))


def judged(based: DataFrame) -> DataFrame:
    """A frame with ``_base`` and ``_failed`` (it is read twice) with ``_posterior`` and ``_kept``."""
    rules = votes()
    counts = (based.where(~F.col("_failed")).groupBy(*[c.alias(f"v_{k}") for k, c in rules.items()])
              .count().collect())  # at most 3 ** 7 rows
    share, rates = estimate([(tuple(r[f"v_{k}"] for k in rules), r["count"]) for r in counts])
    base, w = weights(share, rates)
    odds = F.lit(base)
    for c, by in zip(rules.values(), w, strict=False):
        odds = odds + F.when(c == 1, by[1]).when(c == -1, by[-1]).otherwise(by[0])
    d = based.withColumn("_posterior", 1 / (1 + F.exp(-odds)))
    return d.withColumn("_kept", ~F.col("_failed") & (F.col("_posterior") >= KEEP_AT))


def score_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, _base, _failed, _posterior, _kept). The base columns are worked out twice, for the
    estimate and for the verdict, rather than stored beside the texts."""
    return judged(base_columns(docs, text))


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that the rules keep, with their columns."""
    return C.unpacked(score_quality(docs, text).where("_kept"), docs)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    based = C.cut(base_columns(docs).select(F.col("row.doc_id").alias("doc_id"), "_base", "_failed"))
    return judged(based).select("doc_id", *[F.col(f"_base.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"), F.col("_posterior").alias("posterior"))


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES: dict[str, str] = {}
