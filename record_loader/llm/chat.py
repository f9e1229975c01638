"""Chat formatting over reply trees.

Messages form trees (every message names its parent). Root-to-leaf paths are found by iterated
self-joins that double the step: after k rounds a row reaches 2 ** k ancestors up, so a reply chain
of n messages takes log2(n) rounds. Branches are ranked by the mean score of their messages (equal
ones: the longer, then the smaller leaf), and each chosen path becomes one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. A control string inside a text gets one
backslash after its first character (``</s>`` -> ``<\\/s>``); strings that already have backslashes
there get one more, so unescaping is exact and other text is left as it is. In roles, % and line
breaks are written %25 and %0A. The loss mask is a list of spans of code points: the text of every
assistant turn, without its markers.

A conversation is one value of the output, so its turns meet in one row; nothing else is gathered.
Joins are on (tree, message), which is unique, so a tree with a third of all messages is spread.

Defined cases: null text and role are empty; null conv_id is a conversation; rows of one turn come
in the order of role and text, repeated rows are turns of their own; messages whose parent is
missing are roots; messages on a cycle of parents have no root and belong to no path; an empty
table gives no conversations; extra columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: The template's markers and the control strings of common templates
#: (<|...|>, <s>, </s>, <<SYS>>, <</SYS>>, [INST], [/INST]) from their second character on.
START, END = "<|im_start|>", "<|im_end|>\n"
REST = r"(?=(?:\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + REST, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + REST, r"$1$2")


def _literal(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def write_role(role: Column) -> Column:
    return escape(_literal(_literal(role, "%", "%25"), "\n", "%0A"))


def read_role(role: Column) -> Column:
    return _literal(_literal(unescape(role), "%0A", "\n"), "%25", "%")


def reply_paths(messages: DataFrame, top: int | None = None) -> DataFrame:
    """(tree, leaf, id, up): for every chosen leaf the messages of its path, ``up`` steps above it.
    ``messages`` has tree, id, parent, score; ``top`` bounds the branches taken per tree (None: all)."""
    m = C.cut(messages.select("tree", "id", "parent", "score"))
    known = m.select("tree", F.col("id").alias("parent"))
    roots = m.join(known, ["tree", "parent"], "left_anti").select("tree", "id")
    up = m.join(known, ["tree", "parent"], "left_semi")
    leaves = m.join(up.select("tree", F.col("parent").alias("id")), ["tree", "id"], "left_anti").select("tree", "id")
    # one jump of 2 ** k steps per row, with the score and the number of the messages it passes
    jump = C.cut(up.select("tree", "id", F.col("parent").alias("to"), F.col("score").alias("sum"), F.lit(1).alias("n")))
    jumps, left = [], jump.count()
    limit = max(1, left).bit_length() + 1  # a longer chain than that is a cycle
    heads = C.cut(m.join(roots, ["tree", "id"], "left_semi").select("tree", "id", F.col("id").alias("root"), "score", F.lit(1).alias("n")))
    while left and len(jumps) < limit:
        jumps.append(jump)
        # messages whose jump ends at a message with a known root
        ended = jump.join(heads.select("tree", F.col("id").alias("to"), "root", F.col("score").alias("s"), F.col("n").alias("c")), ["tree", "to"]).select(
            "tree", "id", "root", (F.col("sum") + F.col("s")).alias("score"), (F.col("n") + F.col("c")).alias("n"))
        heads = C.cut(heads.unionByName(ended))
        far = jump.select("tree", F.col("id").alias("to"), F.col("to").alias("beyond"), F.col("sum").alias("s"), F.col("n").alias("c"))
        jump = C.cut(jump.join(far, ["tree", "to"]).select("tree", "id", F.col("beyond").alias("to"), (F.col("sum") + F.col("s")).alias("sum"),
                                                           (F.col("n") + F.col("c")).alias("n")))
        left = jump.count()
    ends = heads.join(leaves, ["tree", "id"], "left_semi")
    if top is not None:
        rank = F.row_number().over(Window.partitionBy("tree").orderBy((F.col("score") / F.col("n")).desc(), F.col("n").desc(), "id"))
        ends = ends.withColumn("rank", rank).where(F.col("rank") <= top)
    path = ends.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("up"))
    for k, step in enumerate(jumps):
        step = step.select("tree", "id", "to")
        path = C.cut(path.unionByName(path.join(step, ["tree", "id"]).select("tree", "leaf", F.col("to").alias("id"), (F.col("up") + F.lit(1 << k)).alias("up"))))
    return path


def format_turns(turns: Column) -> tuple[Column, Column]:
    """Of an array of (role, text) in order: the formatted conversation and its loss spans."""
    parts = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(START), write_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("loss")))
    formatted = F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    sizes = F.transform(parts, lambda p: F.struct(F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["loss"].alias("loss")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    spans = F.aggregate(sizes, state, lambda a, s: F.struct(
        (a["at"] + s["head"] + s["body"] + len(END)).alias("at"),
        F.when(s["loss"], F.array_append(a["spans"], F.struct((a["at"] + s["head"]).alias("start"), (a["at"] + s["head"] + s["body"]).alias("end"))))
        .otherwise(a["spans"]).alias("spans")), lambda a: a["spans"])
    return formatted, spans


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, F.lit(r"<\|im_end\|>\n")), lambda x, i: x.startswith(START))
    body = F.transform(pieces, lambda x: F.substr(x, F.lit(len(START) + 1)))
    return F.transform(body, lambda x: F.struct(
        read_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substr(x, F.length(F.substring_index(x, "\n", 1)) + 2)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def format_trees(messages: DataFrame, top: int | None = None) -> DataFrame:
    """``messages`` (tree, id, parent, role, text, score) -> one row per chosen path: (tree, leaf,
    formatted, loss_spans)."""
    path = reply_paths(messages, top)
    turn = F.struct((-F.col("up")).alias("at"), "role", "text")
    rows = path.join(messages.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), C.whole_text().alias("text")), ["tree", "id"])
    whole = rows.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted, spans = format_turns(F.col("turns"))
    return whole.select("tree", "leaf", formatted.alias("formatted"), spans.alias("loss_spans"))


def as_tree(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as reply chains: every row answers the one before."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("id", F.row_number().over(order).cast("long"))
            .select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), "id",
                    F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "</s>[INST] ok [/INST]"
    kept = C.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    done = format_trees(as_tree(kept.unionByName(more)))
    turns, loss = read_turns(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss_spans"))
    d = done.select("tree", "formatted", turns.alias("turns"), loss.alias("loss"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select(F.when(F.col("tree") != "null", F.col("tree").cast("long")).alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(whole, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (SELECT *, len(text) + len(regexp_extract_all(text, '[<\[]\\*(?:\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\])'))
    + len(replace(replace(role, '%', '%25'), chr(10), '%0A'))
    + len(regexp_extract_all(replace(replace(role, '%', '%25'), chr(10), '%0A'), '[<\[]\\*(?:\|[A-Za-z0-9_]+\|>|/?s>|</?SYS>>|/?INST\])')) + 24 AS chars FROM c),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss, sum(chars) AS chars FROM s GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(whole) AS turns_sha256, CAST(len(loss) AS BIGINT) AS loss_chars,
    sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g
"""

QUERIES = {"op9_chat_formatting": op9_chat_formatting}
ORACLES = {"op9_chat_formatting": SQL}
