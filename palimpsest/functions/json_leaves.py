"""Leaves of JSON documents counted where the documents are read.

A document is walked once, to any depth and whatever its shape: a path is data here, so
text beside an object under one name gives two paths, keys keep their case, and a
repeated key gives its leaves twice.  Tasks count per path (and per distinct value, by a
128-bit name) and send counts, never documents; what a task holds is bounded, whatever
the number of paths and values.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import let_workers_import

#: Paths and values that a task counts before it sends them on.
HELD = 200_000


class _Pairs(list):
    """Members of an object, repeated keys included."""


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def by_value(number: str) -> str:
    """A number's text by its value: 1.50 and 1.5 are one; with an exponent, or too long for a decimal, a double's."""
    digits = len(re.sub(r"\D", "", number))
    if "e" in number.lower() or digits > 38:
        return repr(float(number))
    return format(Decimal(number).normalize() + 0, "f") if "." in number else str(int(number))


_SPELLED = json.JSONDecoder(object_pairs_hook=_Pairs, parse_float=lambda x: (x,), parse_int=lambda x: (x,), parse_constant=_refuse)


def leaves(text: str | None, numbers_by_value: bool = True) -> Iterable[tuple[str, str]]:
    """(path, value) of every leaf, in order; array steps are written ``[]``.

    Nulls and empty containers have no leaf.  A scalar document is the path ``$``, and so
    is a text that is no JSON.
    """
    if text is None:
        return
    try:
        doc = _SPELLED.decode(text)
    except (ValueError, RecursionError):
        yield "$", text
        return
    todo = [("$", doc)]
    while todo:
        path, value = todo.pop()
        if isinstance(value, _Pairs):
            todo.extend([(f"{path}.{k}", v) for k, v in reversed(value)])
        elif isinstance(value, list):
            inner = path + "[]"
            todo.extend([(inner, v) for v in reversed(value)])
        elif isinstance(value, tuple):
            yield path, by_value(value[0]) if numbers_by_value else value[0]
        elif isinstance(value, bool):
            yield path, "true" if value else "false"
        elif value is not None:
            yield path, value


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def profile(df: DataFrame, column: str, detectors: Mapping[str, str]) -> DataFrame:
    """``path, values, distinct_values, <detector>_hits ...`` in one scan.

    A detector runs once per distinct value of a task.  Distinct values are counted by
    their 128-bit names, each sent once per task and path.
    """
    patterns = {name: re.compile(rx) for name, rx in detectors.items()}
    hits = [f"{name}_hits" for name in detectors]
    names = ["path", "name1", "name2", "n", *hits]
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.int64()] * (1 + len(hits))]

    def run(batches):
        held: dict[tuple[str, bytes], int] = {}
        found: dict[bytes, tuple[int, ...]] = {}

        def sent():
            rows = []
            for (path, name), n in held.items():
                one, two = int.from_bytes(name[:8], "little", signed=True), int.from_bytes(name[8:], "little", signed=True)
                rows.append((path, one, two, n, *[n * hit for hit in found[name]]))
            return _batch(rows, names, kinds)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for path, value in leaves(text):
                    name = hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    if name not in found:
                        found[name] = tuple(int(p.search(value) is not None) for p in patterns.values())
                    held[path, name] = held.get((path, name), 0) + 1
                if len(held) > HELD:
                    yield sent()
                    held.clear()
                    found.clear()
        yield sent()

    let_workers_import(df.sparkSession)
    counted = df.select(column).mapInArrow(run, "path string, name1 long, name2 long, n long, " + ", ".join(f"{h} long" for h in hits))
    # hits are the value's own: equal values of all tasks are put together before they are counted as one
    each = counted.groupBy("path", "name1", "name2").agg(*[F.sum(c).alias(c) for c in ("n", *hits)])
    return each.groupBy("path").agg(
        F.sum("n").alias("values"), F.count(F.lit(1)).alias("distinct_values"), *[F.sum(h).alias(h) for h in hits]
    )


def differences(df: DataFrame, original: str, changed: str) -> DataFrame:
    """``path, docs, changed_docs, lost_docs``: both documents of a row walked beside each other, leaves as spelled."""
    names, kinds = ["path", "docs", "changed_docs", "lost_docs"], [pa.string(), *[pa.int64()] * 3]

    def grouped(text: str | None) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for path, value in leaves(text, False):
            found.setdefault(path, []).append(value)
        return found

    def run(batches):
        held: dict[str, list[int]] = {}
        for batch in batches:
            for before, after in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now = grouped(after)
                for path, values in grouped(before).items():
                    counts = held.setdefault(path, [0, 0, 0])
                    there = now.get(path, [])
                    counts[0] += 1
                    counts[1] += values != there
                    counts[2] += len(values) != len(there)
                if len(held) > HELD:
                    yield _batch([(p, *c) for p, c in held.items()], names, kinds)
                    held.clear()
        yield _batch([(p, *c) for p, c in held.items()], names, kinds)

    let_workers_import(df.sparkSession)
    counted = df.select(original, changed).mapInArrow(run, "path string, docs long, changed_docs long, lost_docs long")
    return counted.groupBy("path").agg(*[F.sum(c).alias(c) for c in names[1:]])
