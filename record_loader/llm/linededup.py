"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that are not blank. A line is removed when it lies in a
run that also starts earlier in the corpus: in a smaller doc_id, or earlier in the same document. A run
is ``min_lines`` or more lines, or a single line of ``long_words`` words or more, so copies of one-line
documents and long lines between other lines go too, while a short line alone (a heading, a bracket)
stays. Runs are judged on the input, and blank lines always stay.

1. Every window of ``min_lines`` lines selects its smallest line hash (the rightmost of equals) as
   a fingerprint. Equal windows select the same fingerprint, so any two occurrences of such a run
   share one.
2. Fingerprints that are selected at one place only are dropped (counted map-side first); the
   places of the rest are joined to them.
3. Each surviving place is extended both ways over the windows that selected it; windows are
   matched as a whole by fingerprint and window hash (128 bits), and the earliest start of each
   is found with a map-side minimum. Every window that starts later is a repeat.
4. A long line is a window of its own, whose fingerprint is its own hash.
5. Repeated windows that overlap or touch merge into runs, which go.

No step pairs places with places: a line that a third of all documents share gives one row per
place, which counts and minima reduce inside every task; the joins back are plain equi-joins,
which Spark splits where a key is large. Only hashes and places are shuffled until the last step,
which joins one row per changed document to the texts.

Defined cases: null text is empty (no lines); a text with fewer lines than ``min_lines``
keeps all but long lines; a very long text is one row, split in its task;
documents that share doc_id are ordered by the hash of their texts; rows that share both are one
document and get the same result; null doc_id comes first; an empty table gives no rows; other
columns are carried untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

MIN_LINES = 2
LONG_WORDS = 10


def line_windows(docs: DataFrame, min_lines: int, long_words: int) -> DataFrame:
    """(id, key, at, span, fp, first, run): one row per window of ``min_lines`` lines, and per long line:
    its place, its lines, its fingerprint, whether no window before it selected the same place, and the window's hash."""
    last = min_lines - 1
    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(C.SPACE_CHARS)) != "")
    hashes = F.transform(lines, lambda x: F.xxhash64(x))
    # white space shortens no line, so few lines need their words counted
    long = F.transform(lines, lambda x: F.when(F.length(x) >= 2 * long_words - 1, C.n_words(x) >= long_words).otherwise(False))
    # in a window from i: its smallest hash with its place, larger places first among equals
    least = (f"array_min(transform(sequence(0, {last}), k -> struct(_h[i + k] AS h, -(i + k) AS p)))")
    rows = (f"CASE WHEN size(_h) < {min_lines} THEN array() ELSE transform(sequence(0, size(_h) - {min_lines}), i -> "
            f"struct(i AS at, {least} AS f, xxhash64('run', slice(_h, i + 1, {min_lines})) AS run)) END")
    before = "(i = 0 OR _r[i - 1].f.p != x.f.p)"
    runs = f"transform(_r, (x, i) -> struct(x.at AS at, {min_lines} AS span, x.f.h AS fp, {before} AS first, x.run AS run))"
    alone = ("filter(transform(_h, (h, i) -> CASE WHEN _long[i] THEN struct(i AS at, 1 AS span, xxhash64('line', h) AS fp, true AS first, "
             "xxhash64('alone', h) AS run) END), x -> x IS NOT NULL)")
    return (docs.withColumn("_h", hashes).withColumn("_long", long).select("id", "key", "_h", "_long", F.expr(rows).alias("_r"))
            .select("id", "key", F.explode(F.expr(f"concat({runs}, {alone})")).alias("w")).select("id", "key", "w.*"))


def repeated_windows(docs: DataFrame, min_lines: int = MIN_LINES, long_words: int = LONG_WORDS) -> DataFrame:
    """(id, key, starts): per document the windows (at, span) that start earlier elsewhere."""
    windows = line_windows(docs, min_lines, long_words)
    places = windows.groupBy("fp").agg(F.sum(F.col("first").cast("int")).alias("places")).where("places > 1").select("fp")
    shared = C.cut(windows.join(places, "fp").select("id", "key", "at", "span", "fp", "run"))
    earliest = (shared.groupBy("fp", "run").agg(F.min(F.struct("id", "key", "at")).alias("origin"), F.count("*").alias("n"))
                .where("n > 1"))
    here = F.struct("id", "key", "at")
    return (shared.join(earliest, ["fp", "run"]).where(F.col("origin") < here)
            .groupBy("id", "key").agg(F.collect_set(F.struct("at", "span")).alias("starts")))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, text: str = "text", doc_id: str = "doc_id", long_words: int = LONG_WORDS) -> DataFrame:
    """All columns of ``docs`` and (line_kept_text, line_count, line_removed, line_runs)."""
    body = C.whole_text(text)
    keyed = docs.select(C.row_of(docs), F.col(doc_id).alias("_id"), C.text_key(body).alias("_key"), body.alias("_t"))
    found = repeated_windows(docs.select(F.col(doc_id).alias("id"), C.text_key(body).alias("key"), body.alias("_t")), min_lines, long_words)
    d = (keyed.join(found, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), "left")
         .withColumn("_starts", F.coalesce("starts", F.array().cast("array<struct<at:int,span:int>>")))
         .withColumn("_lines", F.split("_t", "\n")))
    # places of the lines that are not blank, then the places that go
    full = "filter(transform(_lines, (x, i) -> CASE WHEN btrim(x, _space) != '' THEN i END), i -> i IS NOT NULL)"
    which = "array_sort(array_distinct(flatten(transform(_starts, s -> sequence(s.at, s.at + s.span - 1)))))"
    gone = "transform(_which, i -> _full[i])"
    d = d.withColumn("_space", F.lit(C.SPACE_CHARS)).withColumn("_full", F.expr(full)).withColumn("_which", F.expr(which)).withColumn("_gone", F.expr(gone))
    rest = "transform(array_except(sequence(0, size(_lines) - 1), _gone), i -> _lines[i])"
    kept = F.when(F.size("_gone") == 0, F.col("_t")).otherwise(F.array_join(F.expr(rest), "\n"))
    runs = "size(filter(_which, (p, i) -> i = 0 OR p > _which[i - 1] + 1))"
    return C.unpacked(d, docs, line_kept_text=kept, line_count=F.size("_full").cast("long"),
                      line_removed=F.size("_gone").cast("long"), line_runs=F.expr(runs).cast("long"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", F.col("line_count").alias("n_lines"), F.col("line_removed").alias("n_removed"), F.col("line_runs").alias("n_runs"),
        F.sha2("line_kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
    SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS place
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT a.doc_id, a.place, a.line AS l1, b.line AS l2 FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.place = a.place + 1),
r AS (SELECT doc_id, place, row_number() OVER (PARTITION BY l1, l2 ORDER BY doc_id, place) > 1 AS again FROM w),
o AS (SELECT doc_id, place, row_number() OVER (PARTITION BY line ORDER BY doc_id, place) > 1 AS again FROM l
    WHERE len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 10),
gone AS (SELECT doc_id, unnest([place, place + 1]) AS place FROM r WHERE again UNION SELECT doc_id, place FROM o WHERE again),
runs AS (SELECT g.doc_id, count(*) AS n_runs FROM gone g LEFT JOIN gone p ON p.doc_id = g.doc_id AND p.place = g.place - 1
    WHERE p.place IS NULL GROUP BY g.doc_id),
k AS (SELECT d.doc_id, string_split(coalesce(d.text, ''), chr(10)) AS lines, coalesce(x.gone, []) AS gone FROM documents d
    LEFT JOIN (SELECT l.doc_id, list(l.pos) AS gone FROM l JOIN gone USING (doc_id, place) GROUP BY l.doc_id) x USING (doc_id))
SELECT k.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_lines, CAST(len(k.gone) AS BIGINT) AS n_removed, CAST(coalesce(runs.n_runs, 0) AS BIGINT) AS n_runs,
    sha256(array_to_string(list_transform(list_filter(range(1, len(k.lines) + 1), lambda i: NOT list_contains(k.gone, i)), lambda i: k.lines[i]), chr(10))) AS kept_sha256
FROM k LEFT JOIN (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id) c USING (doc_id) LEFT JOIN runs USING (doc_id)
"""

QUERIES = {"op1_line_dedup": op1_line_dedup}
ORACLES = {"op1_line_dedup": SQL}
