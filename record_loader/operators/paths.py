"""Record paths (P10): which records to load out of each outer record, as column expressions.

A path is a list of steps, ``/orders[./status = 'F']/lines[0..2]``:

- ``/name`` is the field of that name, ``/'any name'`` one whose name holds a slash or a bracket,
  ``/*`` every field;
- an array stands for its elements, arrays of arrays too; a filter picks among the elements that one
  parent has: ``[*]`` all, ``[0]`` or ``[-1]`` or ``[0, 2]`` by place, ``[1..3]`` a range of places
  (both ends included), ``[./a/b = 'x']`` by a value (``= != < <= > >=`` and a text, number, ``true``
  or ``false``); a record that is not in an array is an array of one;
- a path without a leading slash is read with dots between its steps.

``typed_hits`` compiles a path over typed records, whose types are known when the plan is made;
``variant_hits`` over open records with types (``map<string,variant>``), decided row by row.  Both give
one array of hits per outer record, in the record's order: arrays are opened by built-in array functions,
so there is one generator for the whole path and no Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import variant_as

_STEP = re.compile(r"/(?:'(?P<quoted>[^']+)'|(?P<name>[^/\[\]']+))(?P<filters>(?:\[(?:'[^']*'|[^\]'])*\])*)")
_FILTER = re.compile(r"\[((?:'[^']*'|[^\]'])*)\]")
_COMPARE = re.compile(r"^\./(?P<field>[^=!<>]+?)\s*(?P<op>=|!=|<=|>=|<|>)\s*(?P<value>'[^']*'|[^'\s]+)$")
_NUMBER = re.compile(r"^[+-]?(\d+\.?\d*|\.\d+)$")


@dataclass(frozen=True)
class Filter:
    """One bracket: places (``kind`` 'at': a tuple), a range ('range': first, last) or a comparison
    ('where': field names, operator, literal)."""

    kind: str
    args: tuple


@dataclass(frozen=True)
class Step:
    name: str
    any: bool = False                      # ``*``
    filters: tuple[Filter, ...] = ()


def parse_path(path: str) -> list[Step]:
    """The steps of ``path``; ``ValueError`` for text that is no path."""
    text = path if path.startswith("/") else "/" + path.replace(".", "/")
    steps, at = [], 0
    while at < len(text):
        m = _STEP.match(text, at)
        if m is None:
            raise ValueError(f"not a record path: {path!r} (at {text[at:]!r})")
        filters = tuple(f for f in (_filter(x.strip(), path) for x in _FILTER.findall(m["filters"])) if f)
        name = m["quoted"] or m["name"].strip()
        steps.append(Step(name, m["quoted"] is None and name == "*", filters))
        at = m.end()
    if not steps:
        raise ValueError(f"not a record path: {path!r}")
    return steps


def _filter(text: str, path: str) -> Filter | None:
    if text == "*":
        return None
    if re.fullmatch(r"-?\d+(\s*,\s*-?\d+)*", text):
        return Filter("at", tuple(int(x) for x in text.split(",")))
    if m := re.fullmatch(r"(-?\d+)\s*\.\.\s*(-?\d+)", text):
        return Filter("range", (int(m[1]), int(m[2])))
    if m := _COMPARE.match(text):
        return Filter("where", (tuple(m["field"].strip().split("/")), m["op"], _literal(m["value"], path)))
    raise ValueError(f"not a filter of a record path: [{text}] in {path!r}")


def _literal(text: str, path: str):
    if text.startswith("'"):
        return text[1:-1]
    if text in ("true", "false"):
        return text == "true"
    if not _NUMBER.match(text):
        raise ValueError(f"not a text, number or truth value: {text!r} in {path!r}")
    return Decimal(text) if "." in text else int(text)


def _compared(value: Column, op: str, literal) -> Column:
    other = F.lit(literal)
    result = {"=": value == other, "!=": value != other, "<": value < other, "<=": value <= other,
              ">": value > other, ">=": value >= other}[op]
    return F.coalesce(result, F.lit(False))


def _passes(f: Filter, size: Column, value_of):
    """The test of one filter on an element and its place."""
    if f.kind == "where":
        names, op, literal = f.args

        def where(e):
            value = value_of(e, names, literal)
            return F.lit(False) if value is None else _compared(value, op, literal)
        return where
    places = [F.lit(n) if n >= 0 else size + F.lit(n) for n in f.args]
    if f.kind == "at":
        return lambda e, i: F.array_contains(F.array(*places), i)
    return lambda e, i: (i >= places[0]) & (i <= places[1])


def _picked(elements: Column, filters: tuple[Filter, ...], value_of) -> Column:
    """The elements that pass the filters one after another; ``value_of(element, names, literal)``
    is the value to compare, or None if there can be none."""
    for f in filters:
        elements = F.filter(elements, _passes(f, F.size(elements), value_of))
    return elements


# typed records ------------------------------------------------------------------------
def _opened(value: Column, dt: T.DataType):
    """(array of records, record type) for a record or an array of records, however deep; else None."""
    if isinstance(dt, T.StructType):
        return F.when(value.isNotNull(), F.array(value)), dt
    if isinstance(dt, T.ArrayType):
        if isinstance(dt.elementType, T.StructType):
            return value, dt.elementType
        if isinstance(dt.elementType, T.ArrayType):
            return _opened(F.flatten(F.filter(value, lambda x: x.isNotNull())), dt.elementType)
    return None


def _typed_value(dt: T.StructType):
    def value_of(e: Column, names, literal):
        t: T.DataType = dt
        for n in names:
            if not isinstance(t, T.StructType) or n not in t.names:
                return None
            e, t = e.getField(n), t[n].dataType
        if isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            return None
        if isinstance(literal, bool):
            return e.try_cast("boolean")
        if isinstance(literal, str):
            return e.cast("string")
        return e if isinstance(t, T.IntegralType) else e.try_cast("decimal(38,10)")
    return value_of


def _common(types: list[T.StructType], path: str) -> T.StructType:
    """One record type with the fields of all; a field must have one type."""
    merged: dict[str, T.DataType] = {}
    for f in (f for t in types for f in t.fields):
        if merged.setdefault(f.name, f.dataType) != f.dataType:
            raise TypeError(f"path {path}: field {f.name} has different types in the records it reaches")
    return T.StructType([T.StructField(n, t) for n, t in merged.items()])


def _shaped(records: Column, dt: T.StructType, to: T.StructType) -> Column:
    if dt == to:
        return records

    def one(r):
        shaped = F.struct(*[(r.getField(f.name) if f.name in dt.names else F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in to.fields])
        return F.when(r.isNotNull(), shaped)
    return F.transform(records, one)


def _flat_map(array: Column, fn) -> Column:
    return F.flatten(F.transform(array, fn))


def _first_of(records: Column, name: str) -> Column:
    """The first value that is there in the field ``name`` of the records."""
    return F.get(F.filter(F.transform(records, lambda r: r.getField(name)), lambda v: v.isNotNull()), F.lit(0))


def typed_hits(fields: dict[str, tuple[Column, T.DataType]], steps: list[Step], path: str):
    """(array of records, record type, [(value, type name) of hits that are no records]).

    ``fields`` are the outer record's.  A name that the type lacks gives no hits."""
    records, dt, others = None, None, []

    def children(get, types, step, last):
        """The children of one record: arrays with their types, and values that are no records."""
        found, plain = [], []
        for n in (types if step.any else [step.name] if step.name in types else []):
            opened = _opened(get(n), types[n])
            if opened is not None:
                array, t = opened
                found.append((_picked(array, step.filters, _typed_value(t)), t))
            elif last:
                plain.append((get(n), types[n].simpleString()))
        return found, plain

    def together(found, to):
        none = F.array().cast(T.ArrayType(to))
        # one element type throughout: a field that may not be null makes another type of array
        parts = [F.coalesce(_shaped(a, t, to).cast(T.ArrayType(to)), none) for a, t in found]
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    def inside(types, step, to):
        return lambda r: together(children(r.getField, types, step, False)[0], to)

    for k, step in enumerate(steps):
        last = k == len(steps) - 1
        if k == 0:
            found, others = children(lambda n: fields[n][0], {n: t for n, (_, t) in fields.items()}, step, last)
            if not found:
                return None, None, others
            dt = _common([t for _, t in found], path)
            records = together(found, dt)
            continue
        types = {f.name: f.dataType for f in dt.fields}
        probe, _ = children(lambda n: F.lit(None), types, step, last)
        if last:
            scalars = [n for n in (types if step.any else [step.name]) if n in types and _opened(F.lit(None), types[n]) is None]
            others = [(_first_of(records, n), types[n].simpleString()) for n in scalars]
        if not probe:
            return None, None, others
        to = _common([t for _, t in probe], path)
        records, dt = _flat_map(F.filter(records, lambda r: r.isNotNull()), inside(types, step, to)), to
    return records, dt, others


# open records with types ----------------------------------------------------------------
def _variant_value(e: Column, names, literal) -> Column:
    path = "$" + "".join(f"['{n}']" for n in names)
    kind = "boolean" if isinstance(literal, bool) else "string" if isinstance(literal, str) else "decimal(38,10)"
    return variant_as(e, kind, path)


def _variant_child(step: Step):
    """One child as an array: its elements, or itself; none for an absent or null child."""
    none = F.array().cast("array<variant>")

    def opened(value: Column) -> Column:
        present = value.isNotNull() & ~F.is_variant_null(value)
        inner = F.coalesce(variant_as(value, "array<variant>"), F.array(value))
        # arrays of arrays: one more level is opened wherever an element is an array
        inner = _flat_map(inner, lambda x: F.coalesce(variant_as(x, "array<variant>"), F.array(x)))
        return F.coalesce(F.when(present, _picked(inner, step.filters, _variant_value)), none)
    return opened


def _variant_children(step: Step):
    """The children of one value that is, or is not, a record."""
    opened = _variant_child(step)
    if not step.any:
        return lambda r: opened(variant_as(r, "variant", f"$['{step.name}']"))
    none = F.array().cast("array<variant>")
    return lambda r: _flat_map(F.coalesce(F.map_values(variant_as(r, "map<string,variant>")), none), opened)


def variant_hits(fields: Column, steps: list[Step]) -> Column:
    """The hits in a ``map<string,variant>``: an array of variants, records or not.  Arrays are opened
    two levels deep at each step."""
    first, values = steps[0], F.map_values(fields)
    if first.any:
        hits = _flat_map(values, _variant_child(first))
    else:
        # a name that stands twice: the later field
        place = F.array_position(F.reverse(F.map_keys(fields)), F.lit(first.name))
        hits = _variant_child(first)(F.when(place > 0, F.try_element_at(values, (F.size(values) - place + 1).cast("int"))))
    for step in steps[1:]:
        hits = _flat_map(hits, _variant_children(step))
    return hits
