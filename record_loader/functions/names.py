"""Field-name normalisation, as a plan-time Python helper (uniform records)
and as a Column expression (open records held in a map).

Strategies:
- ``REMOVE_UNDERSCORE``: upper-case, then delete every ``_``.
- ``PATTERN``: upper-case, then delete every match of the caller's regex.
- ``NONE``: exact, case-sensitive name.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F


def _java_remove(pattern: str, text: str) -> str:
    """Delete every match of a Java regex, the syntax that expressions use, so
    column names and open fields follow one engine.  Needs the JVM of the
    session (one call per column name, on the driver)."""
    context = SparkContext._active_spark_context
    if context is None:
        raise RuntimeError("a name pattern is a Java regex: start a Spark session first")
    return context._jvm.java.util.regex.Pattern.compile(pattern).matcher(text).replaceAll("")


def normalize_name(name: str, translation: str = "REMOVE_UNDERSCORE",
                   pattern: str | None = None) -> str:
    if translation == "NONE":
        return name
    up = name.upper()
    if translation == "REMOVE_UNDERSCORE":
        return up.replace("_", "")
    if translation == "PATTERN":
        return _java_remove(pattern, up) if pattern else up
    raise ValueError(f"unknown translation {translation!r}")


def normalize_name_col(c: Column, translation: str = "REMOVE_UNDERSCORE",
                       pattern: str | None = None) -> Column:
    """The same rule as :func:`normalize_name`, as a JVM-side expression.

    The pattern is a Java regex in both."""
    if translation == "NONE":
        return c
    up = F.upper(c)
    if translation == "REMOVE_UNDERSCORE":
        return F.replace(up, F.lit("_"), F.lit(""))
    if translation == "PATTERN":
        return F.regexp_replace(up, pattern, "") if pattern else up
    raise ValueError(f"unknown translation {translation!r}")


# Fixed value: separator used to normalise all keys of a record in one string
# operation; field names never contain it.
KEY_SEP = "\u0001"


def normalized_keys(fields: Column, translation: str = "REMOVE_UNDERSCORE",
                    pattern: str | None = None) -> Column:
    """The normalised keys of a ``map<string,string>``, aligned with
    ``map_values`` (duplicates kept, in entry order).

    For ``REMOVE_UNDERSCORE`` / ``NONE`` the keys are joined into one string,
    normalised with one ``upper`` / ``replace`` and split again: built-in
    expressions only, so whole-stage codegen covers them.  A ``PATTERN``
    could match across the separator, so it is applied per key."""
    keys = F.map_keys(fields)
    if translation == "NONE":
        return keys
    if translation == "REMOVE_UNDERSCORE":
        joined = F.replace(F.upper(F.array_join(keys, KEY_SEP)), F.lit("_"), F.lit(""))
        return F.when(F.size(keys) > 0, F.split(joined, KEY_SEP)).otherwise(
            F.array().cast("array<string>"))
    return F.transform(keys, lambda k: normalize_name_col(k, translation, pattern))


def last_value_of(fields: Column, norm_keys: Column, key: str) -> Column:
    """The value of the *last* entry whose normalised key is ``key``
    (later fields win), or NULL when no entry has it."""
    p = F.array_position(F.reverse(norm_keys), F.lit(key))
    idx = (F.size(norm_keys) - p + 1).cast("int")
    return F.when(p > 0, F.try_element_at(F.map_values(fields), idx))


def normalize_keys_last_wins(fields: Column, translation: str = "REMOVE_UNDERSCORE",
                             pattern: str | None = None) -> Column:
    """Normalise the keys of a ``map<string,string>``; when two keys normalise
    alike the later entry wins.  Done on the entry array, so it needs no
    session-wide map-key policy."""
    entries = F.transform(
        F.map_entries(fields),
        lambda e: F.struct(normalize_name_col(e["key"], translation, pattern).alias("key"),
                           e["value"].alias("value")))
    n = F.size(entries)
    # keep entry i only if no later entry carries the same normalised key
    kept = F.filter(
        entries,
        lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(n - i - 1, F.lit(0))),
                               lambda x: x["key"] == e["key"]))
    return F.when(fields.isNull(), F.lit(None)).otherwise(F.map_from_entries(kept))
