"""Query recipes over the driver's tables: one per operator of the load
engine, each with the equivalent DuckDB SQL (the correctness oracle).

Stand-ins: ``documents.source`` is a source unit, ``doc_id`` a position;
``events.props`` a raw JSON record; ``conversations`` turns nested records;
``embeddings.embedding`` an array; ``orders`` / ``events`` keyed, versioned
rows.  Binary results are emitted as hex text.  Every recipe reads whole
tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.coerce import uuid_to_string
from ..operators.batches import (batches_executed, coalesce_units, load_receipts, plan_batches,
                                 replacing_merge, rows_inserted, take_batch)
from ..operators.conform import ERROR, conform, conform_open, to_open_records
from ..operators.records import match_report, select_records
from ..operators.routing import (error_annotation, enforce_constraints, missing_target,
                                 TransientLoadError, quarantine_units, resolve_target,
                                 route_batches, route_units, unit_failures)
from ..sinks.ledger import FanOutTarget, LedgerTarget, MergeTarget
from ..sinks.targets import PathTarget, bulk_insert, fresh_dir
from ..sources.files import has_record, parse_open_records, parse_records, read_open_records, read_records
from ..spec import LoadOptions, TargetSpec
from .load import load_batch, load_fan_out

# Fixed values used by the recipes -------------------------------------------------
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MAX_UNITS = 6
LONG_DOC = 20000
SPREAD = 8                      # the test tables are single files
PRICE_CHECK = "o_totalprice < 499000"
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority"]
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
KNOWN_DOC_TARGETS = ["docs_en", "docs_de", "docs_es"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders_spec(extra=()) -> TargetSpec:
    cols = [("o_orderkey", "bigint", True), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
            ("o_orderpriority", "string"), *extra]
    return TargetSpec.of("orders", cols, key=("o_orderkey",))


def events_spec() -> TargetSpec:
    return TargetSpec.of("events", [("event_id", "bigint", True), ("ts", "timestamp_ntz"),
                                    ("user_id", "bigint", True), ("event_type", "string"),
                                    ("value", "double"), ("props", "string")], key=("event_id",))


def _k(props_col="props"):
    return F.get_json_object(F.col(props_col), "$.k").cast("int")


# ---------------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------------
def read_records_json(spark, sf):
    """Events rewritten as JSON-lines record files, read back as typed records."""
    path = fresh_dir(spark, "records-json")
    ev = table(spark, sf, "events")
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(", "),
                    F.expr("substr(props, 2)"))
    ev.select(line.alias("value")).write.text(path)
    recs = read_records(spark, path, "json", "event_id long, k int")
    good, _ = quarantine_units(conform(recs, TargetSpec.of("kv", [("event_id", "bigint", True),
                                                                  ("k", "int")])))
    return good.select("event_id", "k")


def parse_formatted_times(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", TS_FMT).alias("ts"), F.date_format("ts", "yyyy-MM-dd").alias("d"))
    spec = TargetSpec.of("times", [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("d", "date")])
    return conform(ev, spec, LoadOptions(timestamp_format=TS_FMT, date_format="yyyy-MM-dd")).select(
        "event_id", "ts", "d")


def _event_chunks(spark, sf, size=8):
    """Units of up to ``size`` events each (by event id), as JSON-array text."""
    ev = table(spark, sf, "events")
    rec = F.to_json(F.struct("event_id", "user_id", "event_type"))
    return (ev.groupBy(F.floor(F.col("event_id") / size).alias("source_id"))
            .agg(F.sort_array(F.collect_list(F.struct("event_id", rec.alias("j")))).alias("rs"))
            .select("source_id", F.concat(F.lit("["), F.array_join(F.transform("rs", lambda r: r["j"]), ","),
                                          F.lit("]")).alias("text")))


def open_records(spark, sf):
    recs = parse_open_records(_event_chunks(spark, sf), "text")
    return recs.select("source_id", F.col("pos").cast("long").alias("pos"),
                       F.col("fields")["event_id"].cast("long").alias("event_id"),
                       F.col("fields")["event_type"].alias("event_type"))


def malformed_units(spark, sf):
    docs = table(spark, sf, "documents")
    full = F.concat(F.lit("["), F.to_json(F.struct("doc_id", "n_chars", "text")), F.lit("]"))
    staged = docs.select(F.col("doc_id").alias("source_id"), "source", full.alias("full"), "n_chars")
    truncated = F.when(F.col("n_chars") >= LONG_DOC,
                       F.expr("substr(full, 1, length(full) - 2)")).otherwise(F.col("full"))
    units = staged.select("source_id", "source", truncated.alias("text"))
    recs = parse_open_records(units, "text", keep=["source"])
    spec = TargetSpec.of("docs", [("doc_id", "bigint", True), ("n_chars", "bigint"), ("text", "string")])
    c = conform_open(recs, spec, keep=["source_id", "pos", "source"], spread=SPREAD)
    return c.select(F.col("source_id").alias("doc_id"), "source",
                    F.col(ERROR).isNotNull().alias("malformed"))


def open_typed_records(spark, sf):
    """Units of mixed types: an array of bytes, an array of numbers, a record, a text or nothing in a
    binary column, and the event's number, its text or an array of it in a number column."""
    ev = table(spark, sf, "events").select("event_id", "event_type", F.col("event_id").cast("string").alias("id"))
    number, text = F.col("id"), F.concat(F.lit('"'), "event_type", F.lit('"'))
    low, high = (F.col("event_id") % 128).cast("string"), (F.col("event_id") % 128 + 128).cast("string")
    kind = F.col("event_id") % 6
    payload = (F.when(kind == 0, F.concat(F.lit("["), low, F.lit(", 0, -1]"))).when(kind == 1, F.concat(F.lit("["), high, F.lit("]")))
               .when(kind == 3, F.concat(F.lit('{"k": '), number, F.lit("}"))).when(kind == 4, F.lit("null")).otherwise(text))
    count = F.when(kind == 5, F.concat(F.lit("["), number, F.lit("]"))).when(kind == 4, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    units = ev.select(F.col("event_id").alias("source_id"),
                      F.concat(F.lit('{"payload": '), payload, F.lit(', "Event_Id": '), count, F.lit(', "raw": '), payload, F.lit("}")).alias("text"))
    spec = TargetSpec.of("typed", [("payload", "binary"), ("event_id", "bigint"), ("raw", "string")])
    c = conform_open(parse_open_records(units, "text", typed=True), spec, spread=SPREAD)
    return c.select("source_id", F.hex("payload").alias("payload"), "event_id", "raw", F.col(ERROR).alias("error"))


ARRAY_RECORDS = 4000            # records in one of the files that the next query writes


def json_array_split(spark, sf):
    """Events in files of one JSON array each, written out and read back by byte ranges."""
    unit = F.floor(F.col("event_id") / ARRAY_RECORDS)
    files = (table(spark, sf, "events").groupBy(unit.alias("unit"))
             .agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "props"))).alias("all")))
    folder = fresh_dir(spark, "json-arrays")
    files.select("unit", F.to_json("all").alias("value")).write.partitionBy("unit").text(folder)
    recs = read_open_records(spark, f"{folder}/*/*", split=True)
    f = F.col("fields")
    return recs.select(F.regexp_extract("source_id", r"/unit=(\d+)/", 1).cast("long").alias("unit"), "pos",
                       f["event_id"].cast("long").alias("event_id"), f["event_type"].alias("event_type"), f["props"].alias("props"))


SQL_SOURCES = {
    "json_array_split": f"""SELECT event_id // {ARRAY_RECORDS} AS unit,
        row_number() OVER (PARTITION BY event_id // {ARRAY_RECORDS} ORDER BY event_id) - 1 AS pos,
        event_id, event_type, props FROM events""",
    "open_typed_records": """SELECT event_id AS source_id,
            CASE WHEN kind = 0 THEN printf('%02X', event_id % 128) || '00FF'
                 WHEN kind IN (2, 5) THEN hex(event_type) END AS payload,
            CASE WHEN kind <> 5 THEN event_id END AS event_id,
            CASE kind WHEN 0 THEN '[' || (event_id % 128) || ',0,-1]' WHEN 1 THEN '[' || (event_id % 128 + 128) || ']'
                 WHEN 3 THEN '{"k":' || event_id || '}' WHEN 4 THEN NULL ELSE event_type END AS raw,
            CASE kind WHEN 1 THEN 'Cannot convert value of type array to binary' WHEN 3 THEN 'Cannot convert value of type record to binary'
                 WHEN 5 THEN $$Cannot convert field 'EVENTID' of type array to bigint for column 'event_id'$$ END AS error
        FROM (SELECT *, event_id % 6 AS kind FROM events)""",
    "read_records_json": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "parse_formatted_times": "SELECT event_id, ts, CAST(ts AS DATE) AS d FROM events",
    "open_records": """SELECT event_id // 8 AS source_id,
        row_number() OVER (PARTITION BY event_id // 8 ORDER BY event_id) - 1 AS pos,
        event_id, event_type FROM events""",
    "malformed_units": f"SELECT doc_id, source, n_chars >= {LONG_DOC} AS malformed FROM documents",
}


# ---------------------------------------------------------------------------------
# Batching of units
# ---------------------------------------------------------------------------------
def _doc_units(spark, sf):
    """Unit table: one row per source, arrival = its first document."""
    return (table(spark, sf, "documents").groupBy(F.col("source").alias("source_id"))
            .agg(F.min("doc_id").alias("arrival")))


def plan_batches_q(spark, sf):
    return plan_batches(_doc_units(spark, sf), MAX_UNITS).select("source_id", "arrival", "batch_id")


def take_batch_q(spark, sf):
    return take_batch(_doc_units(spark, sf), MAX_UNITS).select("source_id", "arrival")


def coalesce_units_q(spark, sf):
    c = table(spark, sf, "customer")
    first = ["AUTOMOBILE", "BUILDING"]
    a = c.where(F.col("c_mktsegment").isin(first)).select("c_custkey", "c_name", "c_nationkey")
    b = c.where(~F.col("c_mktsegment").isin(first)).select("c_custkey", "c_acctbal", "c_mktsegment")
    return coalesce_units([a, b])


SQL_BATCHES = {
    "plan_batches": f"""SELECT source_id, arrival,
        (row_number() OVER (ORDER BY arrival, source_id) - 1) // {MAX_UNITS} AS batch_id
        FROM (SELECT source AS source_id, min(doc_id) AS arrival FROM documents GROUP BY source)""",
    "take_batch": f"""SELECT source AS source_id, min(doc_id) AS arrival FROM documents
        GROUP BY source ORDER BY arrival, source_id LIMIT {MAX_UNITS}""",
    "coalesce_units": """SELECT c_custkey, c_name, c_nationkey FROM customer
        WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
        UNION ALL BY NAME
        SELECT c_custkey, c_acctbal, c_mktsegment FROM customer
        WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')""",
}


# ---------------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------------
def normalize_remove_underscore(spark, sf):
    o = table(spark, sf, "orders")
    recs = o.select(F.col("o_orderkey").alias("oOrderKey"), F.col("o_custkey").alias("OCustKey"),
                    F.col("o_orderstatus").alias("oOrderStatus"),
                    F.col("o_totalprice").cast("string").alias("oTotalPrice"),
                    F.date_format("o_orderdate", TS_FMT).alias("oOrderDate"),
                    F.col("o_orderpriority").alias("o_order_priority"))
    return conform(recs, orders_spec(), LoadOptions(translation="REMOVE_UNDERSCORE")).select(*ORDERS_COLS)


def normalize_pattern(spark, sf):
    o = table(spark, sf, "orders")
    recs = o.select(F.col("o_orderkey").alias("source_id"),
                    *[F.col(c).alias(c.replace("_", "-").replace("order", "order-")) for c in ORDERS_COLS])
    opts = LoadOptions(translation="PATTERN", pattern="[-_]")
    return conform_open(to_open_records(recs), orders_spec(), opts, spread=SPREAD).select(*ORDERS_COLS)


def match_exact(spark, sf):
    o = table(spark, sf, "orders")
    recs = o.select("o_orderkey", F.col("o_custkey").alias("O_CUSTKEY"), "o_orderstatus",
                    "o_totalprice", "o_orderdate", F.col("o_orderpriority").alias("oOrderPriority"))
    return conform(recs, orders_spec(), LoadOptions(translation="NONE")).select(*ORDERS_COLS)


def align_reorder(spark, sf):
    o = table(spark, sf, "orders")
    recs = o.select("o_orderpriority", "o_totalprice", "o_orderkey", "o_orderdate", "o_custkey",
                    "o_orderstatus")
    return conform(recs, orders_spec())


def null_fill(spark, sf):
    o = table(spark, sf, "orders")
    spec = orders_spec(extra=[("o_comment", "string"), ("o_shippriority", "int")])
    return conform(o, spec).drop(ERROR, "_warning")


def unmatched_field_ignore(spark, sf):
    o = table(spark, sf, "orders").withColumn("o_clerk", F.concat(F.lit("Clerk#"), F.col("o_custkey")))
    return conform(o, orders_spec(), LoadOptions(unmatched_field="ignore")).drop(ERROR, "_warning")


def _event_open_records(spark, sf, extra_on_error=True, drop_value_on_error=False):
    ev = table(spark, sf, "events")
    is_err = F.col("event_type") == "error"
    entries = [F.struct(F.lit("event_id").alias("key"), F.col("event_id").cast("string").alias("value")),
               F.struct(F.lit("user_id").alias("key"), F.col("user_id").cast("string").alias("value")),
               F.struct(F.lit("event_type").alias("key"), F.col("event_type").alias("value")),
               F.struct(F.lit("value").alias("key"), F.col("value").cast("string").alias("value")),
               F.struct(F.lit("trace").alias("key"), F.col("props").alias("value"))]
    arr = F.array(*entries)
    keep = F.filter(arr, lambda e: ((e["key"] != F.lit("trace")) | F.lit(extra_on_error) & is_err)
                    & ((e["key"] != F.lit("value")) | ~(F.lit(drop_value_on_error) & is_err)))
    return ev.select(F.col("event_id").alias("source_id"), F.lit(0).cast("long").alias("pos"),
                     "event_type", F.map_from_entries(keep).alias("fields"))


def _flat_events_spec(extra=()):
    return TargetSpec.of("flat_events", [("event_id", "bigint", True), ("user_id", "bigint"),
                                         ("event_type", "string"), ("value", "double", True), *extra])


def unmatched_field_fail(spark, sf):
    recs = _event_open_records(spark, sf)
    c = conform_open(recs, _flat_events_spec(), LoadOptions(unmatched_field="fail"), spread=SPREAD)
    return unit_failures(c)


def required_column_check(spark, sf):
    recs = _event_open_records(spark, sf, extra_on_error=False, drop_value_on_error=True)
    c = conform_open(recs, _flat_events_spec(), LoadOptions(unmatched_column="fail"), spread=SPREAD)
    return unit_failures(c)


def match_report_q(spark, sf):
    recs = _event_open_records(spark, sf, extra_on_error=True, drop_value_on_error=True)
    return match_report(recs, _flat_events_spec(extra=[("session_id", "string")]))


def colliding_fields(spark, sf):
    ev = table(spark, sf, "events")
    entries = F.array(
        F.struct(F.lit("event_id").alias("key"), F.col("event_id").cast("string").alias("value")),
        F.struct(F.lit("k").alias("key"), _k().cast("string").alias("value")),
        F.struct(F.lit("K").alias("key"), F.col("user_id").cast("string").alias("value")))
    recs = ev.select(F.col("event_id").alias("source_id"), F.lit(0).cast("long").alias("pos"),
                     F.map_from_entries(entries).alias("fields"))
    spec = TargetSpec.of("kv", [("event_id", "bigint", True), ("k", "bigint")])
    return conform_open(recs, spec).select("event_id", "k")


def select_subrecords(spark, sf):
    conv = table(spark, sf, "conversations")
    outer = (conv.groupBy(F.col("conv_id").alias("source_id"), F.floor(F.col("turn") / 4).alias("chunk"))
             .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages")))
    recs = select_records(outer, "messages", keep=("source_id",))
    return recs.select(F.col("source_id").alias("conv_id"), "turn", "role", "text")


# P10: every customer chunk is one JSON unit, orders and their lines nested two levels deep
PATH = "/chunk/orders[./o_orderstatus = 'F']/lines[./l_quantity > 25]"
OPEN_PATH = "/chunk/orders[./o_orderstatus = 'F']/lines"
NO_ORDERS = 10                  # every tenth chunk has a text where lines should be


def _order_chunks(spark, sf) -> DataFrame:
    """Chunks of at most four orders, each with the few lines of an order."""
    lines = (table(spark, sf, "lineitem").groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity", "l_orderkey"))).alias("lines")))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    whole = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return (whole.groupBy(F.floor(F.col("o_orderkey") / 4).alias("source_id"))
            .agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus", "lines"))).alias("orders")))


def record_paths(spark, sf):
    recs = select_records(_order_chunks(spark, sf).select("source_id", F.struct("orders").alias("chunk")), PATH)
    return recs.where(F.col(ERROR).isNull()).select("source_id", "pos", "l_linenumber", "l_partkey", "l_quantity")


def record_paths_open(spark, sf):
    chunks = _order_chunks(spark, sf)
    text = (F.when(F.col("source_id") % NO_ORDERS == 0, F.lit('{"chunk": {"orders": {"o_orderstatus": "F", "lines": "none"}}}'))
            .otherwise(F.to_json(F.struct(F.struct("orders").alias("chunk")))))
    recs = parse_open_records(chunks.select("source_id", text.alias("text")), "text", typed=True)
    spec = TargetSpec.of("lines", [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double")])
    target = PathTarget(fresh_dir(spark, "record-paths"))
    units = load_batch(recs, spec, target, LoadOptions(record_path=OPEN_PATH), open_records=True).units
    stored = target.read(spark).groupBy(F.floor(F.col("l_orderkey") / 4).alias("__u")).agg(F.count(F.lit(1)).alias("stored"))
    return units.join(stored, F.col("source_id") == F.col("__u"), "left").select(
        "source_id", "route", "rows", "error", F.coalesce("stored", F.lit(0)).alias("stored"))


_EV_COLS = "'EVENTID,USERID,EVENTTYPE,VALUE'"
SQL_PROJECTIONS = {
    "normalize_remove_underscore": "SELECT " + ", ".join(ORDERS_COLS) + " FROM orders",
    "normalize_pattern": "SELECT " + ", ".join(ORDERS_COLS) + " FROM orders",
    "match_exact": """SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
        o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders""",
    "align_reorder": "SELECT " + ", ".join(ORDERS_COLS)
                     + ", CAST(NULL AS VARCHAR) AS _error, CAST(NULL AS VARCHAR) AS _warning FROM orders",
    "null_fill": "SELECT " + ", ".join(ORDERS_COLS)
                 + ", CAST(NULL AS VARCHAR) AS o_comment, CAST(NULL AS INTEGER) AS o_shippriority FROM orders",
    "unmatched_field_ignore": "SELECT " + ", ".join(ORDERS_COLS) + " FROM orders",
    "unmatched_field_fail": """SELECT event_id AS source_id,
        'Cannot map field ''trace'' to any column in the database; Normalized Columns: '
        || """ + _EV_COLS + """ AS error FROM events WHERE event_type = 'error'""",
    "required_column_check": """SELECT event_id AS source_id,
        'Record does not have a value for the Required column ''value''' AS error
        FROM events WHERE event_type = 'error'""",
    "match_report": """
        SELECT 'EVENTID' AS field_name, 'event_id' AS column_name, count(*) AS n_records,
               'matched' AS status FROM events
        UNION ALL SELECT 'USERID', 'user_id', count(*), 'matched' FROM events
        UNION ALL SELECT 'EVENTTYPE', 'event_type', count(*), 'matched' FROM events
        UNION ALL SELECT 'VALUE', 'value', count(*), 'matched' FROM events WHERE event_type <> 'error'
        UNION ALL SELECT 'TRACE', NULL, count(*), 'unmatched_field' FROM events WHERE event_type = 'error'
        UNION ALL SELECT NULL, 'session_id', 0, 'unmatched_column'""",
    "colliding_fields": "SELECT event_id, user_id AS k FROM events",
    "select_subrecords": "SELECT conv_id, turn, role, text FROM conversations",
    "record_paths": """SELECT o_orderkey // 4 AS source_id, row_number() OVER (PARTITION BY o_orderkey // 4
            ORDER BY o_orderkey, l_linenumber, l_partkey, l_quantity) - 1 AS pos, l_linenumber, l_partkey, l_quantity
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' AND l_quantity > 25""",
    "record_paths_open": f"""SELECT source_id,
            CASE WHEN n > 0 AND NOT scalar THEN 'success' ELSE 'failure' END AS route,
            CASE WHEN scalar THEN 0 ELSE n END AS rows,
            CASE WHEN scalar THEN 'Path ' || path || ' holds a value of type STRING, not a record'
                 WHEN n = 0 THEN 'No record at path ' || path END AS error,
            CASE WHEN scalar THEN 0 ELSE n END AS stored
        FROM (SELECT o_orderkey // 4 AS source_id, (o_orderkey // 4) % {NO_ORDERS} = 0 AS scalar,
                     $${OPEN_PATH}$$ AS path,
                     count(l_orderkey) FILTER (WHERE o_orderstatus = 'F') AS n
              FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)""",
}


# ---------------------------------------------------------------------------------
# routing
# ---------------------------------------------------------------------------------
def _doc_records(spark, sf, with_null_error=False):
    docs = table(spark, sf, "documents")
    msg = F.concat(F.lit("document too long: "), F.col("n_chars").cast("string"))
    if with_null_error:
        msg = F.when(F.col("lang") == "en", msg)
    bad = F.col("n_chars") >= LONG_DOC
    return docs.select(F.col("source").alias("source_id"), F.col("doc_id").alias("pos"),
                       "doc_id", "lang", "n_chars", F.when(bad, msg).alias("msg"), bad.alias("bad"))


def unit_quarantine(spark, sf):
    recs = _doc_records(spark, sf)
    good, _ = quarantine_units(recs, F.col("bad"), F.col("msg"))
    return good.select("doc_id", F.col("source_id").alias("source"))


def unit_failures_q(spark, sf):
    recs = _doc_records(spark, sf)
    return unit_failures(recs, F.col("bad"), F.col("msg"))


def error_annotation_q(spark, sf):
    recs = _doc_records(spark, sf, with_null_error=True)
    return error_annotation(unit_failures(recs, F.col("bad"), F.col("msg")))


def constraint_batch_reject(spark, sf):
    o = table(spark, sf, "orders").withColumn("batch_id", F.col("o_custkey") % 50)
    accepted, _ = enforce_constraints(o, checks=[PRICE_CHECK], required=["o_custkey"],
                                      key=["o_orderkey"])
    return accepted.select("o_orderkey", "batch_id")


def _doc_units_attrs(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("source_id"), "lang", "source")


def _known_targets(spark):
    # the catalog of existing target tables (not data)
    return spark.createDataFrame([(t,) for t in KNOWN_DOC_TARGETS], "target string")


def load_routes_open(spark, sf):
    """The route table of a load of open-record units, a document each:
    good, truncated, empty, without a record, and without a unit."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    whole = F.concat(F.lit("["), F.to_json(F.struct("doc_id", "n_chars", "text")), F.lit("]"))
    text = (F.when(F.col("doc_id") % 11 == 0, "").when(F.col("doc_id") % 7 == 0, "[]")
            .when(F.col("n_chars") >= LONG_DOC, F.expr("substr(whole, 1, length(whole) - 2)")).otherwise(F.col("whole")))
    units = d.withColumn("whole", whole).select(F.when(F.col("doc_id") % 13 != 0, F.col("doc_id")).alias("source_id"), text.alias("value"))
    spec = TargetSpec.of("docs", [("doc_id", "bigint", True), ("n_chars", "bigint"), ("text", "string")])
    result = load_batch(parse_open_records(units, "value"), spec, PathTarget(fresh_dir(spark, "routes-open")), open_records=True,
                        units=units.select("source_id").where("source_id IS NOT NULL"))
    return result.units.select("source_id", "route", "rows", "error")


def load_routes_typed(spark, sf):
    """The route table of a load of JSON-lines units: blank lines, truncated
    lines, and units of blank lines only."""
    ev = table(spark, sf, "events").select("event_id", "event_type", F.to_json(F.struct("event_id", "value")).alias("line"))
    unit = F.floor(F.col("event_id") / 4).cast("long")
    text = (F.when((F.col("event_id") % 5 == 0) | (unit % 6 == 0), " ")
            .when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), F.expr("substr(line, 1, length(line) - 3)")).otherwise(F.col("line")))
    lines = ev.select(unit.alias("source_id"), F.col("event_id").alias("pos"), text.alias("text"))
    recs = parse_records(lines.where(has_record("text")), "text", "event_id long, value double", keep=["source_id", "pos"])
    spec = TargetSpec.of("kv", [("event_id", "bigint", True), ("value", "double")])
    result = load_batch(recs, spec, PathTarget(fresh_dir(spark, "routes-typed")), units=lines.select("source_id").distinct())
    return result.units.select("source_id", "route", "rows", "error")


def route_outcomes(spark, sf):
    """units of batches whose insert was well, failed for good (with a
    text that mentions a transient error), or failed for now."""
    units = table(spark, sf, "documents").select(F.col("doc_id").alias("source_id"), "lang")
    outcomes = {"en": None, "fr": ValueError("disk full, earlier: java.sql.SQLTimeoutException\nsecond line")}
    other = route_batches(units.where(~F.col("lang").isin(*outcomes)), TransientLoadError("deadlock"))
    for lang, outcome in outcomes.items():
        other = other.unionByName(route_batches(units.where(F.col("lang") == lang), outcome))
    return other.select(F.col("source_id").alias("doc_id"), "route", "error")


def resolve_target_q(spark, sf):
    return resolve_target(_doc_units_attrs(spark, sf), "docs_${lang}").select(
        F.col("source_id").alias("doc_id"), "target")


def missing_target_q(spark, sf):
    named = F.when(F.col("source_id") % 9 == 0, " ").otherwise(F.concat(F.lit("docs_"), F.col("lang")))
    units = resolve_target(_doc_units_attrs(spark, sf).withColumn("table", named), "${table}")
    return missing_target(units, _known_targets(spark)).select(
        F.col("source_id").alias("doc_id"), "target", "error")


def route_units_q(spark, sf):
    units = resolve_target(_doc_units_attrs(spark, sf), "docs_${lang}")
    return route_units(units, _known_targets(spark)).select(
        F.col("source_id").alias("doc_id"), "target", "route", "error")


FAN_TABLES = [f"ev_{k}" for k in range(10)]


def fan_out_load(spark, sf):
    """Users are units that name one of twelve tables, ten of which are known: one load writes all ten; per unit its
    route and the rows that its table holds."""
    ev = table(spark, sf, "events")
    recs = ev.select(F.col("user_id").cast("string").alias("source_id"), F.col("event_id").alias("pos"), "event_id",
                     F.date_format("ts", TS_FMT).alias("ts"), "user_id", "event_type", "props",
                     F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value"))
    units = ev.select(F.col("user_id").cast("string").alias("source_id"), (F.col("user_id") % 12).alias("kind")).distinct()
    target = FanOutTarget(fresh_dir(spark, "fan-out"))
    routes, inserted = load_fan_out(recs, units, "ev_${kind}", FAN_TABLES, events_spec(), target, LoadOptions(timestamp_format=TS_FMT))
    held = (target.read(spark).groupBy(F.col("user_id").cast("string").alias("source_id"), F.col("load_table").alias("target"))
            .agg(F.count(F.lit(1)).alias("held"), F.sum("event_id").alias("id_sum")))
    return (routes.join(held, ["source_id", "target"], "left")
            .select("source_id", "target", "route", "rows", "held", "id_sum", F.lit(inserted).cast("long").alias("inserted")))


_FAILED_SOURCES = f"(SELECT source FROM documents WHERE n_chars >= {LONG_DOC})"
SQL_ROUTING = {
    "fan_out_load": """WITH u AS (SELECT user_id, count(*) AS n, sum(event_id) AS ids,
            user_id % 12 < 10 AND count(*) FILTER (event_id % 97 = 0) = 0 AS good FROM events GROUP BY user_id)
        SELECT CAST(user_id AS VARCHAR) AS source_id, 'ev_' || (user_id % 12) AS target,
            CASE WHEN good THEN 'success' ELSE 'failure' END AS route, CASE WHEN good THEN n ELSE 0 END AS rows,
            CASE WHEN good THEN n END AS held, CASE WHEN good THEN CAST(ids AS BIGINT) END AS id_sum,
            CAST((SELECT sum(n) FROM u WHERE good) AS BIGINT) AS inserted FROM u""",
    "unit_quarantine": f"SELECT doc_id, source FROM documents WHERE source NOT IN {_FAILED_SOURCES}",
    "unit_failures": f"""SELECT source AS source_id,
        arg_min('document too long: ' || CAST(n_chars AS VARCHAR), doc_id) AS error
        FROM documents WHERE n_chars >= {LONG_DOC} GROUP BY source""",
    "error_annotation": f"""SELECT source AS source_id,
        arg_min(CASE WHEN lang = 'en' THEN 'document too long: ' || CAST(n_chars AS VARCHAR)
                ELSE 'Unknown' END, doc_id) AS error
        FROM documents WHERE n_chars >= {LONG_DOC} GROUP BY source""",
    "constraint_batch_reject": f"""SELECT o_orderkey, o_custkey % 50 AS batch_id FROM orders
        WHERE o_custkey % 50 NOT IN (SELECT o_custkey % 50 FROM orders
                                      WHERE NOT ({PRICE_CHECK}) OR o_custkey IS NULL)""",
    "resolve_target": "SELECT doc_id, 'docs_' || lang AS target FROM documents",
    "missing_target": """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE 'docs_' || lang END AS target,
        CASE WHEN doc_id % 9 = 0 THEN 'Target table name is blank' ELSE 'Table not found: docs_' || lang END AS error
        FROM documents WHERE doc_id % 9 = 0 OR 'docs_' || lang NOT IN ('docs_en', 'docs_de', 'docs_es')""",
    "load_routes_open": f"""WITH u AS (SELECT CASE WHEN doc_id % 13 <> 0 THEN doc_id END AS source_id,
            doc_id % 11 = 0 OR doc_id % 7 = 0 AS none, n_chars >= {LONG_DOC} AS cut FROM documents)
        SELECT source_id, CASE WHEN cut AND NOT none THEN 'failure' ELSE 'success' END AS route,
            CASE WHEN cut OR none THEN 0 ELSE 1 END AS rows,
            CASE WHEN cut AND NOT none THEN 'Malformed record' END AS error FROM u WHERE source_id IS NOT NULL
        UNION ALL SELECT NULL, 'failure', 0, 'Record has no unit (source_id is NULL)'
        WHERE EXISTS (SELECT 1 FROM u WHERE source_id IS NULL AND NOT none)""",
    "load_routes_typed": """WITH l AS (SELECT event_id // 4 AS source_id, event_id % 5 = 0 OR (event_id // 4) % 6 = 0 AS blank,
            event_type = 'error' AND event_id % 3 = 0 AS cut FROM events)
        SELECT source_id, CASE WHEN bool_or(cut AND NOT blank) THEN 'failure' ELSE 'success' END AS route,
            CASE WHEN bool_or(cut AND NOT blank) THEN 0 ELSE count(*) FILTER (NOT blank) END AS rows,
            CASE WHEN bool_or(cut AND NOT blank) THEN 'Malformed record' END AS error FROM l GROUP BY source_id""",
    "route_outcomes": """SELECT doc_id, CASE lang WHEN 'en' THEN 'success' WHEN 'fr' THEN 'failure' ELSE 'retry' END AS route,
        CASE lang WHEN 'en' THEN NULL WHEN 'fr' THEN 'disk full, earlier: java.sql.SQLTimeoutException' || chr(10) || 'second line'
        ELSE 'deadlock' END AS error FROM documents""",
    "route_units": """SELECT doc_id, 'docs_' || lang AS target,
        CASE WHEN lang IN ('en', 'de', 'es') THEN 'success' ELSE 'failure' END AS route,
        CASE WHEN lang IN ('en', 'de', 'es') THEN NULL ELSE 'Table not found: docs_' || lang END AS error
        FROM documents""",
}


# ---------------------------------------------------------------------------------
# A1-A3: receipts;  W1: replacing merge
# ---------------------------------------------------------------------------------
def _doc_load(spark, sf):
    units = plan_batches(_doc_units(spark, sf), MAX_UNITS)
    recs = _doc_records(spark, sf).join(units.select("source_id", "batch_id"), "source_id")
    good, failed = quarantine_units(recs, F.col("bad"), F.col("msg"))
    return units, good, failed


def rows_inserted_q(spark, sf):
    _, good, _ = _doc_load(spark, sf)
    return rows_inserted(good)


def batches_executed_q(spark, sf):
    units, good, _ = _doc_load(spark, sf)
    loaded_units = units.join(good.select("source_id").distinct(), "source_id", "left_semi")
    return batches_executed(loaded_units.withColumn("target", F.lit("documents")))


def load_receipts_q(spark, sf):
    units, good, failed = _doc_load(spark, sf)
    counts = good.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"))
    routed = route_batches(units.join(failed, "source_id", "left"), None).join(counts, "source_id", "left")
    return load_receipts(routed.withColumn("rows", F.coalesce("rows", F.lit(0))), "documents")


def replacing_merge_q(spark, sf):
    return replacing_merge(table(spark, sf, "events"), "user_id", ["ts", "event_id"])


_UNITS_SQL = f"""units AS (SELECT source AS source_id, min(doc_id) AS arrival,
        (row_number() OVER (ORDER BY min(doc_id), source) - 1) // {MAX_UNITS} AS batch_id
        FROM documents GROUP BY source),
    failed AS (SELECT DISTINCT source AS source_id FROM documents WHERE n_chars >= {LONG_DOC}),
    good AS (SELECT d.source AS source_id, u.batch_id FROM documents d JOIN units u
             ON d.source = u.source_id WHERE d.source NOT IN (SELECT source_id FROM failed))"""
SQL_RECEIPTS = {
    "rows_inserted": f"WITH {_UNITS_SQL} SELECT batch_id, count(*) AS rows_inserted FROM good GROUP BY batch_id",
    "batches_executed": f"""WITH {_UNITS_SQL} SELECT 'documents' AS target,
        count(DISTINCT batch_id) AS batches_executed, count(*) AS units
        FROM units WHERE source_id IN (SELECT source_id FROM good)""",
    "load_receipts": f"""WITH {_UNITS_SQL}, fe AS (
            SELECT source AS source_id, arg_min('document too long: ' || CAST(n_chars AS VARCHAR), doc_id) AS error
            FROM documents WHERE n_chars >= {LONG_DOC} GROUP BY source),
        cnt AS (SELECT source_id, count(*) AS n FROM good GROUP BY source_id)
        SELECT u.source_id, u.batch_id, 'documents' AS destination,
               CASE WHEN fe.error IS NULL THEN 'success' ELSE 'failure' END AS route,
               CASE WHEN fe.error IS NULL THEN coalesce(cnt.n, 0) ELSE 0 END AS rows,
               fe.error AS error
        FROM units u LEFT JOIN cnt ON u.source_id = cnt.source_id
        LEFT JOIN fe ON u.source_id = fe.source_id""",
    "replacing_merge": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
}


# ---------------------------------------------------------------------------------
# conversions
# ---------------------------------------------------------------------------------
def _k_text(spark, sf):
    ev = table(spark, sf, "events")
    k = _k()
    return ev.select("event_id", F.when(k % 10 == 0, F.concat(k.cast("string"), F.lit("x")))
                     .otherwise(k.cast("string")).alias("k"))


_K_SPEC = TargetSpec.of("kv", [("event_id", "bigint", True), ("k", "int")])


def coerce_numeric(spark, sf):
    return conform(_k_text(spark, sf), _K_SPEC, LoadOptions(on_uncoercible="null")).select("event_id", "k")


def coerce_report(spark, sf):
    c = conform(_k_text(spark, sf), _K_SPEC)
    return c.select("event_id", "k", F.col(ERROR).alias("error"))


def _hex_out(df: DataFrame, key: str, col: str, out: str) -> DataFrame:
    return df.select(key, F.hex(F.col(col)).alias(out))


def binary_utf8(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    spec = TargetSpec.of("blobs", [("doc_id", "bigint"), ("lang", "binary"), ("text", "binary")])
    c = conform(docs, spec, LoadOptions(binary_format="utf-8"))
    return c.select("doc_id", F.hex("lang").alias("lang_hex"), F.sha2("text", 256).alias("text_sha256"))


def binary_hex(spark, sf):
    n = table(spark, sf, "nation")
    h = F.hex(F.col("n_name"))
    recs = n.select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.lower(h)).otherwise(h)
                    .alias("n_name"))
    spec = TargetSpec.of("nation_bin", [("n_nationkey", "int"), ("n_name", "binary")])
    return _hex_out(conform(recs, spec, LoadOptions(binary_format="hex")), "n_nationkey", "n_name", "n_name_hex")


def binary_base64(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.base64(F.col("o_orderkey").cast("string")).alias("payload"))
    spec = TargetSpec.of("orders_bin", [("o_orderkey", "bigint"), ("payload", "binary")])
    return _hex_out(conform(o, spec, LoadOptions(binary_format="base64")), "o_orderkey", "payload", "payload_hex")


def binary_from_bytes(spark, sf):
    n = table(spark, sf, "nation").select(
        "n_nationkey", F.transform(F.split(F.col("n_name"), ""),
                                   lambda ch: F.ascii(ch).cast("tinyint")).alias("n_name"))
    spec = TargetSpec.of("nation_bin", [("n_nationkey", "int"), ("n_name", "binary")])
    return _hex_out(conform(n, spec), "n_nationkey", "n_name", "n_name_hex")


def binary_of_text(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("payload"))
    spec = TargetSpec.of("orders_bin", [("o_orderkey", "bigint"), ("payload", "binary")])
    return _hex_out(conform(o, spec, LoadOptions(binary_from="text")), "o_orderkey", "payload", "payload_hex")


def _reject_counts(spark, sf, dtype):
    """Each vector is its own unit of one record: accepted vs quarantined."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("source_id"),
                                               F.col("vec_id").alias("pos"), "embedding")
    c = conform(e, TargetSpec.of("vecs", [("embedding", dtype)]))
    return c.agg(F.count_if(F.col(ERROR).isNull()).alias("n_accepted"),
                 F.count_if(F.col(ERROR).isNotNull()).alias("n_rejected"))


def binary_reject(spark, sf):
    return _reject_counts(spark, sf, "binary")


def array_reject(spark, sf):
    return _reject_counts(spark, sf, "int")


def flexible_timestamp(spark, sf):
    ev = table(spark, sf, "events")
    ltz = F.col("ts").cast("timestamp")
    r = F.col("event_id") % 4
    text = (F.when(r == 0, F.date_format("ts", TS_FMT))
            .when(r == 1, F.unix_millis(ltz).cast("string"))
            .when(r == 2, F.unix_micros(ltz).cast("string"))
            .otherwise((F.unix_micros(ltz) / F.lit(1e6)).cast("string")))
    recs = ev.select("event_id", text.alias("ts"))
    spec = TargetSpec.of("ts", [("event_id", "bigint"), ("ts", "timestamp_ntz")])
    return conform(recs, spec, LoadOptions(timestamp_format=TS_FMT)).select("event_id", "ts")


def date_from_string_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd")
                                          .alias("o_orderdate"))
    spec = TargetSpec.of("od", [("o_orderkey", "bigint"), ("o_orderdate", "date")])
    return conform(o, spec).select("o_orderkey", "o_orderdate")


def date_from_epoch_ms_q(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.unix_millis(F.col("o_orderdate").cast("date").cast("timestamp")).alias("o_orderdate"))
    spec = TargetSpec.of("od", [("o_orderkey", "bigint"), ("o_orderdate", "date")])
    return conform(o, spec).select("o_orderkey", "o_orderdate")


def to_text_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").alias("key_text"),
                                          F.col("o_orderdate").cast("date").alias("date_text"))
    spec = TargetSpec.of("texts", [("o_orderkey", "bigint"), ("key_text", "string"), ("date_text", "string")])
    return conform(o, spec).select("o_orderkey", "key_text", "date_text")


def enum_check_q(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("source_id"), F.lit(0).alias("pos"),
                                          "o_orderkey", "o_orderstatus")
    spec = TargetSpec.of("status", [("o_orderkey", "bigint"),
                                    ("o_orderstatus", "string", False, ("F", "O"))])
    good, _ = quarantine_units(conform(o, spec))
    return good.select("o_orderkey", "o_orderstatus")


def uuid_to_string_q(spark, sf):
    o = table(spark, sf, "orders")
    h = F.md5(F.col("o_orderkey").cast("string"))
    u = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                    F.substring(h, 17, 4), F.substring(h, 21, 12))
    value, err = uuid_to_string(u)
    return o.select("o_orderkey", value.alias("uuid"), err.isNull().alias("valid"))


def record_to_json_q(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.struct("lang", "source").alias("meta"))
    spec = TargetSpec.of("docs_meta", [("doc_id", "bigint"), ("meta", "string")])
    return conform(d, spec).select("doc_id", "meta")


def null_to_default_q(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    joined = d.join(table(spark, sf, "labels"), "doc_id", "left")
    spec = TargetSpec.of("labels", [("doc_id", "bigint", True), ("quality", "int", True),
                                    ("toxic", "int", True)])
    return conform(joined, spec, LoadOptions(on_null_required="default")).select("doc_id", "quality", "toxic")


SQL_CONVERSIONS = {
    "coerce_numeric": """SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0
        THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k FROM events""",
    "coerce_report": """SELECT event_id,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0
             THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
        CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0
             THEN 'Cannot convert field ''k'' of type string to int for column ''k''' END AS error
        FROM events""",
    "binary_utf8": "SELECT doc_id, hex(lang) AS lang_hex, sha256(text) AS text_sha256 FROM documents",
    "binary_hex": "SELECT n_nationkey, hex(n_name) AS n_name_hex FROM nation",
    "binary_base64": "SELECT o_orderkey, hex(CAST(o_orderkey AS VARCHAR)) AS payload_hex FROM orders",
    "binary_from_bytes": "SELECT n_nationkey, hex(n_name) AS n_name_hex FROM nation",
    "binary_of_text": "SELECT o_orderkey, hex(CAST(o_orderkey AS VARCHAR)) AS payload_hex FROM orders",
    "binary_reject": """SELECT count(*) FILTER (WHERE embedding IS NULL OR len(embedding) = 0) AS n_accepted,
        count(*) FILTER (WHERE len(embedding) > 0) AS n_rejected FROM embeddings""",
    "array_reject": """SELECT count(*) FILTER (WHERE embedding IS NULL) AS n_accepted,
        count(*) FILTER (WHERE embedding IS NOT NULL) AS n_rejected FROM embeddings""",
    "flexible_timestamp": """SELECT event_id,
        CASE WHEN event_id % 4 = 1 THEN date_trunc('millisecond', ts) ELSE ts END AS ts FROM events""",
    "date_from_string": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "date_from_epoch_ms": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "to_text": """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_text,
        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_text FROM orders""",
    "enum_check": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "uuid_to_string": """SELECT o_orderkey,
        substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 9, 4)
        || '-' || substr(md5(CAST(o_orderkey AS VARCHAR)), 13, 4) || '-'
        || substr(md5(CAST(o_orderkey AS VARCHAR)), 17, 4) || '-'
        || substr(md5(CAST(o_orderkey AS VARCHAR)), 21, 12) AS uuid, true AS valid FROM orders""",
    "record_to_json": """SELECT doc_id, '{"lang":"' || lang || '","source":"' || source || '"}' AS meta
        FROM documents""",
    "null_to_default": """SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}


# ---------------------------------------------------------------------------------
# K1-K3: sinks
# ---------------------------------------------------------------------------------
def _orders_records(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("source_id"), F.lit(0).cast("long").alias("pos"),
                    F.col("o_orderkey").alias("oOrderKey"), F.col("o_custkey").alias("oCustKey"),
                    "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
                    F.date_format("o_orderdate", TS_FMT).alias("o_orderdate"), "o_orderpriority")


def _orders_target_spec():
    return TargetSpec.of("orders", [("o_orderkey", "bigint", True), ("o_custkey", "bigint"),
                                    ("o_orderstatus", "string"), ("o_totalprice", "double"),
                                    ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
                         key=("o_orderkey",), checks=(PRICE_CHECK.replace("499000", "1e12"),))


def bulk_insert_q(spark, sf):
    """Conformed orders appended to a parquet target in one job, read back."""
    target = PathTarget(fresh_dir(spark, "bulk-insert"))
    opts = LoadOptions()
    spec = _orders_target_spec()
    res = load_batch(_orders_records(spark, sf), spec, target, opts)
    res.units.unpersist()
    return target.read(spark).select(*ORDERS_COLS)


def atomic_insert_q(spark, sf):
    """A first batch lands; a second one breaking a CHECK leaves the target as it was."""
    target = PathTarget(fresh_dir(spark, "atomic-insert"))
    opts = LoadOptions()
    spec = _orders_target_spec()
    load_batch(_orders_records(spark, sf), spec, target, opts).units.unpersist()
    strict = TargetSpec.of("orders", spec.columns, key=spec.key, checks=(PRICE_CHECK,))
    res = load_batch(_orders_records(spark, sf), strict, target, opts, batch_id=1)
    res.units.unpersist()
    return target.read(spark).select(*ORDERS_COLS)


def merge_into_target_q(spark, sf):
    """W1 into a stored target: three loads of the events, each replacing the stored rows of its users."""
    target = MergeTarget(fresh_dir(spark, "merge-target"), key=("user_id",), version=("ts", "event_id"), buckets=16)
    ev = table(spark, sf, "events")
    for k in range(3):
        bulk_insert(ev.where(F.col("event_id") % 3 == k), target, token=f"load-{k}")
    bulk_insert(ev, target, token="load-1")                       # a replay of a load that was committed
    return target.read(spark).select(*ev.columns)


def stored_key_reject_q(spark, sf):
    """F3 against the target: orders load; the same orders again break the stored keys as a batch, and
    other orders of the same table load.  Per order: how often it is stored, and its batch's error."""
    target = LedgerTarget(fresh_dir(spark, "stored-keys"))
    spec = _orders_target_spec()
    spec = TargetSpec.of("orders", spec.columns, key=spec.key, unique_key=True)
    records = _orders_records(spark, sf)
    key = [c for c in records.columns if c.replace("_", "").lower() == spec.key[0].replace("_", "").lower()][0]
    low = F.col(f"`{key}`").cast("long") % 2 == 0
    errors = []
    for k, part in enumerate((records.where(low), records, records.where(~low))):
        res = load_batch(part, spec, target, LoadOptions(), batch_id=k, token=f"orders-{k}")
        errors.append(res.units.select(F.lit(k).alias("batch_id"), "route", "error").distinct())
        res.units.unpersist()
    said = errors[0].unionByName(errors[1]).unionByName(errors[2])
    said = said.agg(*[F.max(F.when(F.col("batch_id") == k, F.col("route"))).alias(f"route_{k}") for k in range(3)], F.max("error").alias("error"))
    stored = target.read(spark).groupBy(spec.key[0]).agg(F.count("*").alias("copies"))
    return stored.join(F.broadcast(said))                                            # one row


SQL_SINKS = {
    "merge_into_target": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) WHERE rn = 1""",
    "stored_key_reject": """SELECT o_orderkey, 1 AS copies, 'success' AS route_0, 'failure' AS route_1, 'success' AS route_2,
        'key (o_orderkey) is stored already' AS error FROM orders""",
    "bulk_insert": "SELECT " + ", ".join(ORDERS_COLS) + " FROM orders",
    "atomic_insert": "SELECT " + ", ".join(ORDERS_COLS) + " FROM orders",
}
