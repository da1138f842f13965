"""Suffix dedup of repeated byte strings by bucket-pointer refinement.

Suffixes that start the same 400 bytes are found without sorting all suffixes:

* Each window of 400 bytes has an anchor, its smallest 64-gram (the last of equal
  ones).  Windows are put into initial buckets by that q-gram, windows in a row with
  one anchor together as a cell.  Equal windows have equal anchors at equal offsets.
* A bucket is refined by the identifiers of what stands at the offsets before and
  behind the anchor: a cell's own identifier names all the bytes of its windows, its
  core identifier the bytes that all its windows share.  Equal identifiers: all its
  windows repeat.  A core that nothing else has: none does.  The others are split into
  cells of 16 windows, then of one, and refined again by the same step; a group whose
  cells are known repeats sends on one of them, so identifiers found are used again
  instead of the members.

Identifiers are 128-bit names of the bytes, so a bucket needs no sort in one place:
refinement is counting by name, aggregated before each shuffle, whatever the bucket's
size.  Joins that hand a name's count back split a common name's rows.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import BASE, BASE_INV, _BYTE, keyed, longs, mix, powers, slices, table
from palimpsest.session import written

LENGTH = 400
GRAM = 64
UNIT = 16
_SECOND = _BYTE[::-1].copy()
#: Low bits of a gram's hash that give way to its offset, which is below two spans.
_AT = (1 << 10) - 1


class Names:
    """128-bit names of byte spans of a slice, by prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        up = powers(n, BASE, "up")
        self.down = powers(n + 1, BASE_INV, "down")
        self.sums = np.zeros((2, n + 1), np.uint64)
        for k, values in enumerate((_BYTE, _SECOND)):
            np.cumsum(values[data] * up, out=self.sums[k, 1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray, side: int = 0) -> np.ndarray:
        got = (self.sums[side][end] - self.sums[side][start]) * self.down[start]
        return mix(mix(got + (end - start).astype(np.uint64)) + salt.astype(np.uint64)).view(np.int64)


def anchors(names: Names, n: int) -> np.ndarray:
    """The anchor of the window at each position (windows over a text's edge included: not used).

    Of equal grams the last one counts, by its offset from the block the window starts
    in: the choice depends on the window's bytes alone, however long the text is.
    """
    span = LENGTH - GRAM + 1
    at = np.arange(max(0, n - GRAM + 1))
    grams = names.of(at, at + GRAM, np.zeros(1, np.int64)).view(np.uint64) & ~np.uint64(_AT)
    # smallest key of `span` in a row: a running minimum to the block's end and one from the next block's start
    blocks = -(-len(grams) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(grams)] = grams
    grid = padded.reshape(blocks, span)
    offset = np.arange(span, dtype=np.uint64)
    ahead = np.minimum.accumulate(grid | (np.uint64(_AT - span) - offset), axis=1).ravel()
    behind = np.minimum.accumulate((grid | (np.uint64(_AT) - offset))[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = max(0, n - LENGTH + 1)
    start = np.arange(windows)
    low = np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows])
    low = np.where(start % span == 0, behind[:windows], low)  # a whole block: nothing of the next one
    return start - start % span + (np.uint64(_AT) - (low & np.uint64(_AT))).astype(np.int64)


def first_cells(rows: DataFrame) -> DataFrame:
    """Level 0: runs of windows with one anchor, in texts of at least LENGTH bytes."""

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
            for row, _, data, offsets in slices(batch, "_text"):
                n = len(data)
                if n < LENGTH:
                    continue
                names = Names(data)
                anchor = anchors(names, n)
                doc = np.searchsorted(offsets, np.arange(len(anchor)), side="right") - 1
                valid = np.arange(len(anchor)) + LENGTH <= offsets[doc + 1]
                new = np.ones(len(anchor), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(anchor)) - 1
                live = valid[first]
                first, last = first[live], last[live]
                p, d = anchor[first], doc[first]
                core = names.of(p, p + GRAM, np.zeros(1, np.int64))
                yield _cells(k1[row + d], k2[row + d], first - offsets[d], last - offsets[d], p - offsets[d], names, first, last, p - first, core)

    return rows.select("_k1", "_k2", "_text").mapInArrow(run, CELLS)


CELLS = "_k1 long, _k2 long, lo long, hi long, p long, u1 long, u2 long, core long"


def _cells(k1, k2, lo, hi, p, names: Names, first, last, salt, core, whole=None) -> pa.RecordBatch:
    """whole: False where a cell is cut by the text's edge, so that its bytes have no name in common with others."""
    u1, u2 = (names.of(first, last + LENGTH, salt, side) for side in (0, 1))
    mask = None if whole is None else ~whole
    return pa.RecordBatch.from_arrays(
        [longs(k1), longs(k2), longs(lo), longs(hi), longs(p), pa.array(u1, mask=mask), pa.array(u2, mask=mask), pa.array(core)],
        ["_k1", "_k2", "lo", "hi", "p", "u1", "u2", "core"],
    )


def next_cells(rows: DataFrame, asked: DataFrame, unit: int) -> DataFrame:
    """Cells asked for, split into cells of `unit` windows aligned to the anchor."""
    lists = asked.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("lo", "hi", "p")).alias("cells"))
    lists = written(lists, "suffix-asked")
    texts = rows.join(lists, ["_k1", "_k2"]).select(
        "_k1", "_k2", "_text", F.col("cells.lo").alias("lo"), F.col("cells.hi").alias("hi"), F.col("cells.p").alias("p")
    )

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
            for row, count, data, offsets in slices(batch, "_text"):
                names = Names(data)
                part = batch.slice(row, count)
                per = np.diff(np.asarray(part.column(3).offsets))
                lo, hi, p = (part.column(k).flatten().to_numpy() for k in (3, 4, 5))
                d = np.repeat(np.arange(count), per)
                j0, j1 = (p - hi) // unit, (p - lo) // unit
                times = j1 - j0 + 1
                of = np.repeat(np.arange(len(lo)), times)
                j = j0[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
                d, p = d[of], p[of]
                size = np.diff(offsets)[d]
                high, low = p - j * unit, p - j * unit - unit + 1
                ok = (high >= 0) & (low + LENGTH <= size)
                d, p, size, high, low = d[ok], p[ok], size[ok], high[ok], low[ok]
                a, b = np.maximum(low, 0), np.minimum(high, size - LENGTH)
                base = offsets[d]
                core = names.of(base + high, base + low + LENGTH, p - low)
                yield _cells(k1[row + d], k2[row + d], a, b, p, names, base + a, base + b, p - a, core, (a == low) & (b == high))

    return texts.mapInArrow(run, CELLS)


def refined(cells: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(repeated, open): cells all of whose windows repeat, and cells to split further.

    open holds cells whose core repeats but whose whole does not, and one cell of each
    repeated whole with such a core.  Counted keys are written before they are joined, so
    that adaptive execution can split the cells of a very common core.
    """
    cores = written(cells.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), f"{label}-cores")
    live = written(cells.join(cores, "core"), f"{label}-live")
    place = F.struct("_k1", "_k2", "p", "lo")
    wholes = live.filter("u1 IS NOT NULL").groupBy("u1", "u2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    wholes = written(wholes, f"{label}-wholes")
    marked = live.join(wholes, ["u1", "u2"], "left")
    marked = written(marked.select(*live.columns, F.col("n").isNotNull().alias("again"), (place == F.col("first")).alias("one")), f"{label}-marked")
    unsure = written(marked.filter("NOT again").select("core").distinct(), f"{label}-unsure")
    asked = marked.filter("NOT again OR one").join(unsure, "core", "left_semi").select("_k1", "_k2", "lo", "hi", "p")
    return marked.filter("again").select("_k1", "_k2", "lo", "hi"), asked


def repeats(rows: DataFrame) -> DataFrame:
    """(_k1, _k2, spans): per text, the window starts [lo, hi] whose 400 bytes start elsewhere as well."""
    found, asked = refined(first_cells(rows), "suffix-0")
    for level, unit in enumerate((UNIT, 1), 1):
        more, asked = refined(next_cells(rows, asked, unit), f"suffix-{level}")
        found = found.unionAll(more)
    return found.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, runs (removed [start, end) bytes), kept (the bytes left).

    Null texts count as empty; texts under 400 bytes have nothing to remove.  A text of
    any length is one slice of its task, which holds some 15 numbers per byte of it.  Rows that
    repeat are copies of each other and lose every byte, if they have 400.  A cut can
    split a character: kept is binary.  Other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    spans = written(repeats(rows), "suffix-spans")
    joined = rows.join(spans, ["_k1", "_k2"], "left").select(
        "_id", "_text", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi")
    )
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sizes, runs, kept = [], [], []
            texts, los, his = (batch.column(k) for k in (1, 2, 3))
            for k in range(batch.num_rows):
                data = texts[k].as_buffer().to_pybytes()
                sizes.append(len(data))
                own = []
                if los[k].is_valid and len(los[k]):
                    for lo, hi in sorted(zip(los[k].as_py(), his[k].as_py(), strict=True)):
                        if own and lo <= own[-1][1]:
                            own[-1][1] = max(own[-1][1], hi + LENGTH)
                        else:
                            own.append([lo, hi + LENGTH])
                edges = [0, *[x for run in own for x in run], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                runs.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), longs(sizes), pa.array(runs, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "runs", "kept"],
            )

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, runs array<array<long>>, kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes",
        F.aggregate("runs", F.lit(0).cast("long"), lambda total, r: total + r[1] - r[0]).alias("n_removed"),
        F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
