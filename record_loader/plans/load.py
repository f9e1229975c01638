"""One batch load, end to end: conform -> per-unit verdicts -> one bulk
insert -> a route and receipt for every unit.

Two passes over the records, whatever the options:

1. **Verdict pass** — one aggregation of the conformed records by unit:
   record count, failing records, first failing position, index of the first
   constraint broken.  Every buffer is fixed-width, so it is a hash
   aggregation with map-side combine: a unit holding a third of all rows is
   reduced inside every task and only one row per (unit, task) is shuffled.
   The error text is read for the failed units' first failing rows only.
   Units that the caller lists but that hold no record get a verdict too.
   The unit, failure and violation counts come from one action over the small
   unit table.  With ``unique_key`` the keys of the good records are compared
   with each other and with the stored ones, once: the rejected batches are
   checkpointed, and insert and routes read these few rows.
2. **Insert pass** — the conformed records of the loadable units appended to
   the target as one insert; the insert job itself counts the rows it writes
   (``Observation``).  When no unit failed and no batch is rejected the
   records go in as they are, without a join.

``LoadOptions.snapshot`` says what the second pass reads: the converted batch
kept from the first (``cache``), or the input once more (``rescan``, for input
that does not change and batches larger than the cluster's disks).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.batches import load_receipts, replacing_merge
from ..operators.conform import ERROR, conform, conform_open, output_columns, spread_records
from ..operators.routing import (UNKNOWN, constraint_list, duplicate_key_batches,
                                 duplicate_key_message, missing_target, resolve_target,
                                 route_batches, stored_key_batches, stored_key_message, violation_code,
                                 violation_message)
from ..sinks.targets import bulk_insert, shared_dir
from ..spec import LoadOptions, TargetSpec

NO_UNIT = "Record has no unit (source_id is NULL)"
NOT_LISTED = "Unit is not in the unit table"


class BatchRolledBack(RuntimeError):
    """Raised with rollback-on-failure: nothing was written, and the batch's
    units stay queued (a stream replays the same micro-batch)."""


@dataclass
class LoadResult:
    loaded: DataFrame       # rows appended to the target
    units: DataFrame        # one row per unit: source_id, batch_id, route, rows, error
    failed: DataFrame       # quarantined units (unit-level failures)
    rejected: DataFrame     # batches rejected by the target's constraints
    outcome: BaseException | None
    n_units: int = 0
    tables: list | None = None          # the cached per-unit tables the others derive from
    rows_inserted: int = 0               # counted by the insert job (Observation)

    def receipts(self, load_name: str, destination: str, attempt: int = 1) -> DataFrame:
        """A3: one receipt per unit — load, batch, unit, route, rows, error,
        destination, attempt (the layout streams append per micro-batch)."""
        return load_receipts(self.units, destination).select(
            F.lit(load_name).alias("load_name"), "batch_id", "source_id", "route", "rows", "error",
            "destination", F.lit(attempt).cast("int").alias("attempt"))

    def release(self) -> None:
        """Drop the cached per-unit tables (small, but a stream makes some per
        micro-batch)."""
        for df in self.tables or ():
            df.unpersist()


def conform_records(records: DataFrame, spec: TargetSpec, opts: LoadOptions,
                    open_records: bool = False) -> DataFrame:
    if opts.record_path:
        from ..operators.records import select_records
        records = select_records(records, opts.record_path)
    return conform_open(records, spec, opts) if open_records else conform(records, spec, opts)


def constraints_of(spec: TargetSpec, opts: LoadOptions):
    return constraint_list(spec.checks, spec.required if opts.on_null_required == "keep" else ())


def unit_stats(conformed: DataFrame, spec: TargetSpec, opts: LoadOptions) -> DataFrame:
    """One row per (unit, batch): records, failing records, first failing
    position, index of the first constraint broken.  Every aggregate buffer is
    fixed-width (positions are numbers, with a ``record_path`` too), so Spark
    aggregates by hash, map-side first."""
    bad = F.col(ERROR).isNotNull()
    return conformed.groupBy("source_id", "batch_id").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if(bad).alias("__bad"),
        F.min(F.when(bad, F.col("pos"))).alias("__bad_pos"),
        F.min(violation_code(constraints_of(spec, opts))).alias("__vcode"))


def unit_verdicts(conformed: DataFrame, spec: TargetSpec, opts: LoadOptions,
                  stats: DataFrame | None = None, failures: bool = True) -> DataFrame:
    """One row per (unit, batch): records, first error, first constraint broken.

    A unit fails if any of its records does, whatever their positions; the
    error *text* is read only for failed units: their first failing rows
    (left out when ``failures`` says there are none)."""
    stats = unit_stats(conformed, spec, opts) if stats is None else stats
    if failures:
        failing = conformed.where(F.col(ERROR).isNotNull()).select("source_id", "batch_id", "pos", ERROR)
        first = failing.groupBy("source_id", "batch_id").agg(
            F.coalesce(F.min_by(ERROR, "pos"), F.min(ERROR)).alias("__msg"))
        stats = stats.join(first.withColumnsRenamed({"source_id": "__u", "batch_id": "__b"}), _same_unit(), "left")
        error = F.when(F.col("__bad") > 0, F.coalesce(F.col("__msg"), F.lit(UNKNOWN)))
    else:
        error = F.lit(None).cast("string")
    return stats.select("source_id", "batch_id", "n_records", error.alias("error"), F.col("__vcode").alias("vcode"))


def _same_unit():
    return F.col("source_id").eqNullSafe(F.col("__u")) & F.col("batch_id").eqNullSafe(F.col("__b"))


def _of_units(conformed: DataFrame, units: DataFrame) -> DataFrame:
    """The records of the units; a null batch is a batch of its own, as in the verdicts and routes."""
    return conformed.join(units.select(F.col("source_id").alias("__u"), F.col("batch_id").alias("__b")), _same_unit(), "left_semi")


def with_empty_units(stats: DataFrame, listed: DataFrame) -> DataFrame:
    """The unit table and the listed units (``source_id``, ``batch_id``) that hold no record."""
    known = stats.select(F.col("source_id").alias("__u"), F.col("batch_id").alias("__b"))
    empty = listed.select("source_id", "batch_id").distinct().join(known, _same_unit(), "left_anti")
    none = {"n_records": 0, "__bad": 0, "__bad_pos": None, "__vcode": None}
    return stats.unionByName(empty.select("source_id", "batch_id", *[F.lit(v).cast(stats.schema[k].dataType).alias(k) for k, v in none.items()]))


def plan_load(records: DataFrame, spec: TargetSpec, opts: LoadOptions | None = None,
              open_records: bool = False, batch_id: int | None = None,
              dedupe_version=None, units: DataFrame | None = None, target=None):
    """The plans of a load: (conformed, units, accepted, failed, rejected).

    ``units`` (the argument) lists the batch's units, so that those without a
    record get their verdict; ``units`` (the result) is the per-unit verdict
    table, and ``accepted`` holds the target's columns plus ``source_id`` /
    ``batch_id``.  Everything stays lazy."""
    return _planned(records, spec, opts, open_records, batch_id, dedupe_version, False, units,
                    _stored_keys(records, spec, dedupe_version, target))[:5]


def _checks_keys(spec: TargetSpec, dedupe_version) -> bool:
    return bool(spec.unique_key and spec.key and dedupe_version is None)


def _stored_keys(records: DataFrame, spec: TargetSpec, dedupe_version, target, token: str | None = None) -> DataFrame | None:
    """the keys that the target holds, but for those of this very load
    (a replay must not meet its own rows); None if there is nothing to ask."""
    if not _checks_keys(spec, dedupe_version) or not hasattr(target, "stored_keys"):
        return None
    return target.stored_keys(records.sparkSession, spec.key, token)


def _planned(records, spec, opts, open_records, batch_id, dedupe_version, persist, units, stored=None):
    """:func:`plan_load` and the number of units.  With ``persist`` the unit
    table is cached and counted by one action, and joins that have nothing to
    remove are left out."""
    opts = (opts or LoadOptions()).validate()
    if "batch_id" not in records.columns:
        records = records.withColumn("batch_id", F.lit(batch_id or 0).cast("long"))
    conformed = conform_records(spread_records(records, opts.spread_partitions), spec, opts, open_records)
    conformed = conformed.withColumn(ERROR, F.when(F.col("source_id").isNull(), F.lit(NO_UNIT)).otherwise(F.col(ERROR)))
    if units is not None and "batch_id" not in units.columns:
        units = units.withColumn("batch_id", F.lit(batch_id or 0).cast("long"))
    cached = []
    if persist and opts.snapshot == "cache":
        conformed = conformed.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(conformed)
    try:
        return _plans(conformed, spec, opts, dedupe_version, persist, units, cached, stored)
    except BaseException:
        for df in cached:
            df.unpersist()
        raise


def _plans(conformed, spec, opts, dedupe_version, persist, listed, cached, stored):
    stats = unit_stats(conformed, spec, opts)
    if listed is not None:
        stats = with_empty_units(stats, listed)
    n_units = n_failed = n_broken = None
    if persist:
        stats = stats.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(stats)
        n_units, n_failed, n_broken = stats.agg(                                   # verdict pass
            F.count(F.lit(1)), F.count_if(F.col("__bad") > 0), F.count("__vcode")).first()
    verdicts = unit_verdicts(conformed, spec, opts, stats, n_failed != 0)
    if n_failed:
        verdicts = verdicts.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(verdicts)
        verdicts.count()                                                            # error texts of failed units
    failed = verdicts.where(F.col("error").isNotNull()).select("source_id", "batch_id", "error")
    good = verdicts.where(F.col("error").isNull())
    messages = [m for _, m in constraints_of(spec, opts)]
    codes = good.where(F.col("vcode").isNotNull()).select("batch_id", "vcode")
    unique = _checks_keys(spec, dedupe_version)
    if unique:
        messages = messages + [duplicate_key_message(spec.key)]
        good_rows = conformed if n_failed == 0 else _of_units(conformed, good)
        codes = codes.unionByName(duplicate_key_batches(good_rows, spec.key).select("batch_id", F.lit(len(messages)).alias("vcode")))
        if stored is not None:
            messages = messages + [stored_key_message(spec.key)]
            codes = codes.unionByName(stored_key_batches(good_rows, stored, spec.key).select("batch_id", F.lit(len(messages)).alias("vcode")))
    # the first constraint in the table's order, as for a batch on its own
    clean = n_broken == 0 and not unique
    rejected = (codes.groupBy("batch_id").agg(F.min("vcode").alias("vcode"))
                .select("batch_id", violation_message(F.col("vcode"), messages).alias("reason")))
    if persist and unique:                                                          # key pass: one row per rejected batch
        # cut from the target's rows, which hold this load's own once it is inserted
        shared_dir(conformed.sparkSession)
        rejected = rejected.checkpoint().persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(rejected)
        clean = rejected.count() == 0
    accepted = conformed
    if n_failed != 0 or not clean:
        refused = rejected.select(F.col("batch_id").alias("__b"))
        kept = lambda df: df.join(refused, F.col("batch_id").eqNullSafe(F.col("__b")), "left_anti")
        counted = persist and unique and n_failed == 0                              # small, or of many batches: no join by unit
        accepted = kept(conformed) if counted else _of_units(conformed, kept(good))
    if dedupe_version is not None and spec.key:
        accepted = replacing_merge(accepted, list(spec.key) + ["batch_id"], dedupe_version)
    return conformed, verdicts, accepted, failed, rejected, n_units, clean, cached


def load_batch(records: DataFrame, spec: TargetSpec, target, opts: LoadOptions | None = None,
               open_records: bool = False, batch_id: int | None = None,
               dedupe_version=None, token: str | None = None, units: DataFrame | None = None, beside: tuple = ()) -> LoadResult:
    """Load one batch of units into ``target``.  ``beside`` holds columns that
    are written beside the target's own.

    Unit failures (parse, mapping, conversion) quarantine only their unit.
    A constraint violation rejects its batch: with rollback-on-failure this
    raises :class:`BatchRolledBack` before anything is written; otherwise
    the batch's units are routed to ``failure``.  An insert error routes the
    batch's good units to ``retry`` (transient) or ``failure``.  An empty
    batch is a no-op; a unit of ``units`` without a record succeeds with no
    rows."""
    opts = (opts or LoadOptions()).validate()
    conformed, verdicts, accepted, failed, rejected, n_units, clean, cached = _planned(
        records, spec, opts, open_records, batch_id, dedupe_version, True, units,
        _stored_keys(records, spec, dedupe_version, target, token))
    done = False
    try:
        first = rejected.select("reason").first() if not clean and opts.rollback_on_failure else None
        if first is not None:
            raise BatchRolledBack(f"batch rejected by the target's constraints: {first[0]}")
        outcome: BaseException | None = None
        rows_inserted = 0
        if n_units:
            # A1: rows bound to the insert, counted by the insert job itself
            obs = Observation("rows_inserted")
            to_write = accepted.select(*output_columns(accepted, spec), *beside).observe(obs, F.count(F.lit(1)).alias("rows"))
            try:                                      # insert pass
                counted = bulk_insert(to_write, target, opts, token)
                rows_inserted = int(obs.get.get("rows", 0)) if counted is None else counted
            except Exception as e:  # noqa: BLE001 - routed, not swallowed
                if opts.rollback_on_failure:
                    raise BatchRolledBack(str(e)) from e
                outcome = e
        # routes and failed units stay lazy over the cached unit table
        routed = _route(verdicts, None if clean else rejected, outcome)
        loaded = accepted if outcome is None else accepted.limit(0)
        done = True
        tables = [df for df in cached if df is not conformed]
        return LoadResult(loaded, routed, failed, rejected, outcome, n_units, tables, rows_inserted)
    finally:
        for df in ([conformed] if done else cached):
            df.unpersist()


def _route(verdicts: DataFrame, rejected: DataFrame | None, outcome: BaseException | None) -> DataFrame:
    j = verdicts.select("source_id", "batch_id", "n_records", "error")
    if rejected is not None:
        j = (j.join(rejected.select(F.col("batch_id").alias("__b"), "reason"), F.col("batch_id").eqNullSafe(F.col("__b")), "left")
             .select("source_id", "batch_id", "n_records", F.coalesce("error", "reason").alias("error")))
    routed = route_batches(j, outcome)
    rows = F.when(F.col("route") == "success", F.col("n_records")).otherwise(F.lit(0)).cast("long")
    return routed.select("source_id", "batch_id", "route", rows.alias("rows"), "error")


def _named_units(records: DataFrame, units: DataFrame, template: str, names: list):
    """(units with their known target, failure routes of everything else)."""
    spark = records.sparkSession
    per_unit = (resolve_target(units, template).withColumn("target", F.coalesce("target", F.lit(""))).groupBy("source_id")
                .agg(F.min("target").alias("target"), F.max("target").alias("__other")))
    resolved = per_unit.where(F.col("target") == F.col("__other")).select("source_id", "target")
    torn = per_unit.where(F.col("target") != F.col("__other"))
    known = spark.createDataFrame([(t,) for t in names], "target string")
    missing = (missing_target(resolved, known)
               .select("source_id", "target", F.lit("failure").alias("route"), "error"))
    missing = missing.unionByName(torn.select("source_id", "target", F.lit("failure").alias("route"),
                                              F.concat(F.lit("Unit names two targets: "), "target", F.lit(", "), "__other").alias("error")))
    listed = per_unit.select(F.col("source_id").alias("__u"))
    stray = (records.select("source_id").distinct().join(listed, F.col("source_id").eqNullSafe(F.col("__u")), "left_anti")
             .select("source_id", F.lit(None).cast("string").alias("target"), F.lit("failure").alias("route"),
                     F.when(F.col("source_id").isNull(), F.lit(NO_UNIT)).otherwise(F.lit(NOT_LISTED)).alias("error")))
    missing = missing.unionByName(stray)
    named = resolved.join(known, "target", "left_semi").select("source_id", F.col("target").alias("__target"))
    return named, missing


def load_fan_out(records: DataFrame, units: DataFrame, template: str, names: list, spec: TargetSpec, target,
                 opts: LoadOptions | None = None, open_records: bool = False, token: str | None = None):
    """K4 in one pass: units that name their table through ``${attr}``, tables that share one layout, and a
    :class:`~record_loader.sinks.ledger.FanOutTarget` that holds them all.  The records are read and converted once
    and written by one job, whatever the number of tables.

    Every table is a batch of its own in the verdicts: a record that breaks a constraint rejects the units of its
    table, not those of others.  The insert is one for all tables, so its failure routes the good units of all of
    them.  Units without a known table come back as failure routes, as in :func:`load_per_target`, which is the way
    for tables of different layouts or with keys to check.
    Returns ``(routes, rows)``: one row per unit (source_id, target, route, rows, error), and the rows inserted."""
    if spec.unique_key:
        raise ValueError("a load into many tables checks no keys: use load_per_target")
    if "load_table" in spec.names:
        raise ValueError("load_table names the table of a row")
    named, missing = _named_units(records, units, template, names)
    table_of = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("batch_id") + 1).cast("int"))
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("__target")) - 1
    numbered = named.select("source_id", number.cast("long").alias("batch_id"))
    of = numbered.withColumnRenamed("source_id", "__u")
    dealt = records.drop("batch_id").join(of, F.col("source_id").eqNullSafe(F.col("__u"))).drop("__u")
    result = load_batch(dealt, spec, target, opts, open_records, token=token, units=numbered, beside=(table_of.alias("load_table"),))
    routes = result.units.select("source_id", table_of.alias("target"), "route", "rows", "error")
    lost = missing.select("source_id", "target", "route", F.lit(0).cast("long").alias("rows"), "error")
    return routes.unionByName(lost), result.rows_inserted


def load_per_target(records: DataFrame, units: DataFrame, template: str, targets: dict,
                    opts: LoadOptions | None = None, open_records: bool = False):
    """Every unit names its target through ``${attr}`` in
    ``template``; each known target gets its own load of its units' records.

    ``units`` has one row per unit (``source_id`` + attribute columns);
    ``targets`` maps a table name to ``(TargetSpec, target)`` or to
    ``(TargetSpec, target, LoadOptions)``.  The target is joined to the
    records once and the joined records are kept, clustered by target, while
    the loads read their slices.  No record is left without a route: units
    whose resolved name is blank or unknown, units that the unit table lists
    with different names, and units of records (or records without one) that it
    does not list are returned as failure routes; a unit listed twice with one
    name is one unit.  The loop runs over the caller's list of tables, never
    over collected data.
    Returns ``({name: LoadResult}, missing_units)``."""
    named, missing = _named_units(records, units, template, list(targets))
    of = named.select(F.col("source_id").alias("__u"), "__target")
    dealt = records.join(of, F.col("source_id").eqNullSafe(F.col("__u"))).drop("__u").persist(StorageLevel.MEMORY_AND_DISK)
    results = {}
    try:
        for name, (spec, target, *own) in targets.items():
            mine = F.col("__target") == F.lit(name)
            results[name] = load_batch(dealt.where(mine).drop("__target"), spec, target, own[0] if own else opts, open_records,
                                       units=named.where(mine).select("source_id"))
    finally:
        dealt.unpersist()
    return results, missing
