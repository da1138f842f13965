"""Helpers shared by the operators: batches of UTF-8 bytes, word hashes, components.

Texts reach numpy as the Arrow buffers Spark sends, in slices of bounded bytes, so a
task needs memory for one slice (or one text, if that is longer) and not for a
partition.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import measured_bytes, written

SLICE_BYTES = 1_000_000
U64 = np.uint64


#: Rows of texts that Spark hands to a Python worker at once.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default, unless the session names its own size."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _k1, _k2, _text): rows that repeat both id and text share the 128-bit key."""
    return df.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.col(id_col)).alias("_k1"),
        F.xxhash64(F.col(text_col)).alias("_k2"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )


# ---------------------------------------------------------------- bytes of texts


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of consecutive rows; offsets start at 0."""
    array = batch.column(batch.schema.get_field_index(column))
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    n = len(array)
    if not n:
        return
    _, offs, data = array.buffers()
    offs = np.frombuffer(offs, kind)[array.offset : array.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = int(np.searchsorted(offs, offs[row] + limit, side="right")) - 1
        last = min(n, max(last, row + 1))
        yield row, last - row, data[offs[row] : offs[last]], offs[row : last + 1] - offs[row]
        row = last


def give_back() -> None:
    """Return memory that is no longer used to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable) -> Callable:
    """The same function of batches, giving back at its end what it took.

    A worker goes on to the next stage's tasks; memory that its allocators keep would
    count against an executor beside what those tasks need.
    """

    def lean_run(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean_run


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(lean(run), schema)


# ---------------------------------------------------------------- hashing

_RNG = np.random.default_rng(20240501)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWERED = _BYTE.copy()
LOWERED[65:91] = LOWERED[97:123]
STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(n: int, base: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = LOWERED) -> np.ndarray:
    """One 64-bit hash per byte span: a polynomial by prefix sums, then mixed."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values[data] * powers(n, BASE, "up"), out=sums[1:])
    got = (sums[ends] - sums[starts]) * powers(n + 1, BASE_INV, "down")[starts]
    return mix(got + (ends - starts).astype(np.uint64))


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[0:0x30] = NOT_ALNUM[0x3A:0x61] = NOT_ALNUM[0x7B:0x80] = True
NOT_ALNUM[65:91] = False  # A-Z count as the letters they are lowered to


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (one more than texts)."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    inside[:n] = ~breaks[data]
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words make one shingle."""
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width if len(rolled) else 0):
        rolled += words[k : n - width + 1 + k] * STEP[k]
    rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            yield mix(np.array([(words[a:b] * STEP[width : width + b - a]).sum(dtype=np.uint64)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def parities(values: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """So many words of 64 bits for each run of values: bit k is the parity of those whose hash is k modulo all bits."""
    bits = 64 * words
    at = np.repeat(np.arange(len(sizes)) * bits, sizes) + (mix(values ^ STEP[4]) % U64(bits)).astype(np.int64)
    odd = np.bincount(at, minlength=len(sizes) * bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(-1, words)


def strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())


def blobs(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def longs(values) -> pa.Array:
    return pa.array(np.asarray(values).astype(np.int64, copy=False), pa.int64())


# ---------------------------------------------------------------- components


def _forest(batches):
    """Edges of a partition reduced to a spanning forest, every node linked to its root."""
    import pandas as pd

    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x] = top
            x = up
        return top

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 2_000_000:
            yield pd.DataFrame([(x, root(x)) for x in parent], columns=["u", "v"])
            parent.clear()
    if parent:
        yield pd.DataFrame([(x, root(x)) for x in parent], columns=["u", "v"])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Large-star and small-star rounds on (u, v) with u > v; each round is a written
    table, so a lost executor repeats one round.  Minima are aggregated before the
    shuffle and written, so the join with a hub's rows broadcasts them or is one that
    adaptive execution splits.
    """
    links = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    links = written(links.mapInPandas(_forest, "u long, v long").filter("u <> v").distinct(), label)
    seen = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
        large = both.filter("v > u").join(small_side(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        links = written(small.filter("u <> v").distinct(), label)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )


# ---------------------------------------------------------------- small sides

SMALL_SIDE = 32 * 1024 * 1024


def small_side(df: DataFrame) -> DataFrame:
    """Broadcast hint if the measured rows fit SMALL_SIDE; otherwise the join shuffles."""
    return F.broadcast(df) if measured_bytes(df) <= SMALL_SIDE else df


# ---------------------------------------------------------------- bounded training


def thinned(keys: DataFrame, order: str, wanted: int, spare: float) -> DataFrame | None:
    """Keys whose hash `order` is among the smallest, some spare * wanted of them; None if there are no more.

    A cutoff from the keys' number leaves as many at any size, so that a bounded sample
    is no sort of every task's best rows in one task.
    """
    count = keys.count()
    if count <= spare * wanted:
        return None
    return keys.filter(F.col(order) < F.lit(int(spare * wanted / count * 2.0**64) - (1 << 63)))


def sampled(keys: DataFrame, rows_of: Callable[[DataFrame], DataFrame], wanted: dict[int, int]) -> pa.Table:
    """(_text, y): of each class the rows with the smallest `_o`, at most as many as wanted, on the driver.

    keys: (doc_id, y, _o); rows_of joins them with what makes a row, and may drop some: if
    too few of a thinned class are left, more of it is taken.
    """
    found = []
    for y, n in wanted.items():
        own = keys.filter(F.col("y") == y)
        for spare in (4.0, 64.0, math.inf):
            thin = thinned(own, "_o", n, spare)
            rows = rows_of(own if thin is None else thin).orderBy("_o", "_text").limit(n)
            got = rows.select("_text", F.col("y").cast("long").alias("y")).toArrow()
            if thin is None or len(got) == n:
                break
        found.append(got)
    return pa.concat_tables(found)


def trained(rows: pa.Table, train: Callable[[list[bytes], list[int]], tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """What train makes of a bounded sample (_text, y), on the driver."""
    texts, labels = [t.as_py().encode() for t in rows.column("_text")], rows.column("y").to_pylist()
    del rows
    give_back()
    made = [np.atleast_1d(np.asarray(x, np.float64)) for x in train(texts, labels)]
    del texts
    give_back()
    return made
