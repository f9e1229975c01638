"""Unit quarantine (F1, F2), batch rejection on constraint violation (F3),
transient / permanent routing (F4) and target resolution (F5, K4).

Units (input files or caller-named source ids) are the unit of failure: one
bad record sends its whole unit to ``failure`` while the other units carry
on.  The per-unit and per-batch verdicts are small aggregates (one row per
failed unit / batch), computed with partial aggregation so a unit holding a
third of all rows never lands whole in one task.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .conform import ERROR

UNKNOWN = "Unknown"


# F1 / F2 ------------------------------------------------------------------------
def unit_failures(df: DataFrame, bad: Column | None = None, error: Column | None = None,
                  unit: str = "source_id", pos: str = "pos") -> DataFrame:
    """One row per failed unit: the unit and the error of its first failing
    record (by ``pos``); a failure without a message reads ``Unknown``.

    One pass.  The error of a record is made into an array of none or one
    message and exploded: a filter on it would be pushed below the projection
    and work the expression out twice.  ``min_by`` (a sort-based aggregate, its
    buffer holds text) then sees failing rows only, map-side first."""
    error = F.col(ERROR) if error is None else error
    message = error if bad is None else F.when(bad, F.coalesce(error, F.lit(UNKNOWN)))
    flagged = df.select(F.col(unit), F.col(pos).alias("__pos"),
                        F.explode(F.array_compact(F.array(message))).alias("__err"))
    return flagged.groupBy(unit).agg(F.coalesce(F.min_by("__err", "__pos"), F.min("__err")).alias("error"))


def quarantine_units(df: DataFrame, bad: Column | None = None, error: Column | None = None,
                     unit: str = "source_id", pos: str = "pos") -> tuple[DataFrame, DataFrame]:
    """Split records into (good records, failed units).

    ``bad`` defaults to ``_error IS NOT NULL``.  Good records are an anti join
    against the distinct ids of failing rows (a hash aggregation), null-safe:
    records without a unit are one unit of their own.  Spark picks the join
    from the sizes it finds; nothing runs until a result is used."""
    flag = F.col(ERROR).isNotNull() if bad is None else bad
    ids = df.where(flag).select(F.col(unit).alias("__failed")).distinct()
    good = df.join(ids, F.col(unit).eqNullSafe(F.col("__failed")), "left_anti")
    return good, unit_failures(df, bad, error, unit, pos)


def error_annotation(failed: DataFrame) -> DataFrame:
    """every failed unit carries a message, ``Unknown`` if it had none."""
    return failed.withColumn("error", F.coalesce(F.col("error"), F.lit(UNKNOWN)))


# F3 ---------------------------------------------------------------------------------
def constraint_list(checks=(), required=()) -> list[tuple[Column, str]]:
    """(broken?, message) for every CHECK expression, then NOT NULL of each
    required column, in that order."""
    conds = [(~F.coalesce(F.expr(c), F.lit(True)), f"CHECK constraint violated: {c}") for c in checks]
    return conds + [(F.col(f"`{r}`").isNull(), f"NOT NULL constraint violated: {r}") for r in required]


def violation_code(conds: list[tuple[Column, str]]) -> Column:
    """1-based index of the first constraint a row breaks (an int, so the
    aggregate over it is hash-based), or NULL."""
    if not conds:
        return F.lit(None).cast("int")
    return F.coalesce(*[F.when(c, F.lit(i + 1)) for i, (c, _) in enumerate(conds)])


def violation_message(code: Column, messages: list[str]) -> Column:
    """The message of a constraint's index; NULL for NULL."""
    if not messages:
        return F.lit(None).cast("string")
    return F.when(code.isNotNull(), F.element_at(F.array(*[F.lit(m) for m in messages]), code))


def duplicate_key_batches(df: DataFrame, key, batch: str = "batch_id") -> DataFrame:
    """Batches holding a key twice (shuffles every row by key)."""
    return (df.groupBy(batch, *key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
            .select(batch).distinct())


def duplicate_key_message(key) -> str:
    return f"duplicate key ({', '.join(key)})"


def stored_key_batches(df: DataFrame, stored: DataFrame, key, batch: str = "batch_id") -> DataFrame:
    """Batches holding a key that the target's stored rows hold too.  The keys
    of the batch are the small side of a semi-join, so Spark prunes the stored
    side by them (runtime filters) or broadcasts them by their size."""
    mine = df.select(F.col(batch), *key)
    theirs = stored.select(*[F.col(f"`{k}`").alias(f"__s{i}") for i, k in enumerate(key)])
    same = [F.col(f"`{k}`") == F.col(f"__s{i}") for i, k in enumerate(key)]
    return mine.join(theirs, reduce(lambda a, b: a & b, same), "left_semi").select(batch).distinct()


def stored_key_message(key) -> str:
    return f"key ({', '.join(key)}) is stored already"


def constraint_violations(df: DataFrame, checks=(), required=(), key=(),
                          batch: str = "batch_id") -> DataFrame:
    """One row per batch that breaks a CHECK expression, a NOT NULL column
    or (with ``key``) holds a key twice, with the first reason found.

    Rows carry the index of the first constraint they break, so the
    per-batch aggregate is a hash aggregate over an int."""
    conds = constraint_list(checks, required)
    messages = [m for _, m in conds] + ([duplicate_key_message(key)] if key else [])
    parts = []
    if conds:
        parts.append(df.select(F.col(batch), violation_code(conds).alias("__code")).where(F.col("__code").isNotNull()))
    if key:
        parts.append(duplicate_key_batches(df, key, batch).withColumn("__code", F.lit(len(messages))))
    if not parts:
        return df.select(batch, F.lit(None).cast("string").alias("reason")).limit(0)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return (out.groupBy(batch).agg(F.min("__code").alias("__code"))
            .select(batch, violation_message(F.col("__code"), messages).alias("reason")))


def enforce_constraints(df: DataFrame, checks=(), required=(), key=(), batch: str = "batch_id"
                        ) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted rows, rejected batches): one violating row
    rejects its whole batch and leaves the target untouched for it.  Rows
    without a batch are one batch of their own."""
    if batch not in df.columns:
        df = df.withColumn(batch, F.lit(0).cast("long"))
    rejected = constraint_violations(df, checks, required, key, batch)
    ids = rejected.select(F.col(batch).alias("__rejected"))
    return df.join(ids, F.col(batch).eqNullSafe(F.col("__rejected")), "left_anti"), rejected


# F4 -----------------------------------------------------------------------------------
#: Fixed value: the SQL error class that says a retry may work.
TRANSIENT_CLASS = "java.sql.SQLTransientException"
#: Its standard subclasses, for errors that arrive as text only.
_TRANSIENT_NAMES = ("java.sql.SQLTransientException", "java.sql.SQLTransientConnectionException",
                    "java.sql.SQLTimeoutException", "java.sql.SQLTransactionRollbackException")


class TransientLoadError(RuntimeError):
    """A failure worth retrying (lost connection, timeout, deadlock)."""


def _jvm_error(exc: BaseException):
    """The JVM exception behind a Python one, or None."""
    found = getattr(exc, "java_exception", None)
    origin = getattr(exc, "_origin", None)
    return found if found is not None else getattr(origin, "java_exception", origin)


def _transient_in_jvm(error) -> bool:
    """Spark's own wrappers (its job and task failures) are passed through;
    then the error itself or its cause must be of the transient class."""
    while error is not None and error.getClass().getName().startswith("org.apache.spark."):
        error = error.getCause()
    for e in (error, error.getCause() if error is not None else None):
        kind = e.getClass() if e is not None else None
        while kind is not None:
            if kind.getName() == TRANSIENT_CLASS:
                return True
            kind = kind.getSuperclass()
    return False


def is_transient(exc: BaseException | None) -> bool:
    """Transient if the exception, or the one it wraps (one level down), is a
    transient SQL error by its class.  What an error says is never searched,
    except that a text which *starts* with the name of a transient class is an
    error that reached Python as text."""
    for e in (exc, getattr(exc, "__cause__", None) if exc is not None else None):
        if e is None:
            continue
        if isinstance(e, TransientLoadError):
            return True
        jvm = _jvm_error(e)
        if jvm is not None and hasattr(jvm, "getClass"):
            if _transient_in_jvm(jvm):
                return True
        elif re.split(r"[:\s]", str(e), maxsplit=1)[0] in _TRANSIENT_NAMES:
            return True
    return False


def outcome_route(outcome: BaseException | None) -> tuple[str, str | None]:
    """(route, error) of a batch after its insert was attempted; the whole
    text of the error is kept."""
    if outcome is None:
        return "success", None
    return ("retry" if is_transient(outcome) else "failure"), (str(outcome) or UNKNOWN)


def route_batches(units: DataFrame, outcome: BaseException | None) -> DataFrame:
    """Give every unit of a batch its route after the insert was attempted:
    success, or retry / failure by the kind of error.  Units that already
    carry an error keep it and go to failure."""
    route, message = outcome_route(outcome)
    own = F.col("error") if "error" in units.columns else F.lit(None).cast("string")
    return (units.withColumn("route", F.when(own.isNotNull(), F.lit("failure")).otherwise(F.lit(route)))
            .withColumn("error", F.coalesce(own, F.lit(message).cast("string"))))


# F5 / K4 -------------------------------------------------------------------------------
_ATTR = re.compile(r"\$\{([^}]*)\}")


def resolve_target(units: DataFrame, template: str, out: str = "target") -> DataFrame:
    """Substitute ``${attr}`` in ``template`` with each unit's attribute
    column (missing attribute -> empty text), as a column expression."""
    pieces: list[Column] = []
    last = 0
    for m in _ATTR.finditer(template):
        if m.start() > last:
            pieces.append(F.lit(template[last:m.start()]))
        name = m.group(1).strip()
        pieces.append(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
                      if name in units.columns else F.lit(""))
        last = m.end()
    if last < len(template):
        pieces.append(F.lit(template[last:]))
    expr = F.concat(*pieces) if pieces else F.lit("")
    return units.withColumn(out, F.trim(expr))


def missing_target(units: DataFrame, targets: DataFrame, target: str = "target") -> DataFrame:
    """Units whose resolved target is blank or unknown, with the error that
    names the missing table.  ``targets`` has one row per known table."""
    known = targets.select(F.col(target).alias("__t")).distinct()
    blank = units.where(F.col(target).isNull() | (F.trim(F.col(target)) == ""))
    blank = blank.withColumn("error", F.lit("Target table name is blank"))
    unknown = (units.where(F.length(F.trim(F.col(target))) > 0)
               .join(known, F.col(target) == F.col("__t"), "left_anti")
               .withColumn("error", F.concat(F.lit("Table not found: "), F.col(target))))
    return blank.unionByName(unknown)


def route_units(units: DataFrame, targets: DataFrame, target: str = "target",
                unit: str = "source_id") -> DataFrame:
    """Route every unit: ``failure`` for a blank / unknown target, else
    ``success`` (a later insert failure re-routes via :func:`route_batches`)."""
    miss = missing_target(units, targets, target).select(unit, "error")
    return (units.join(miss, unit, "left")
            .withColumn("route", F.when(F.col("error").isNull(), F.lit("success"))
                        .otherwise(F.lit("failure"))))
