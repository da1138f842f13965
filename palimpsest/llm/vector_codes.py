"""Product codes of vectors, found by equal-average search.

A vector is cut into equal parts, and each part is coded by the nearest entry of its
position's codebook.  Entries are sorted by the sum of their components.  A part's search
starts at its own sum and goes outwards on both sides, the nearer sum first: for
dimension m, (difference of sums)^2 / m never exceeds the squared distance, so once it
strictly exceeds the best distance found, nothing farther out can be as near, and the
search ends with the exact nearest entry.

All arithmetic is on integers.  A round is one pass over the written vectors; tasks send
each entry's sums, and codebooks are of fixed size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import longs, small_side, strings, table
from palimpsest.llm.lattice import matrix, smallest, squared, totals, whole_numbers
from palimpsest.session import inline_table, written

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2

SCHEMA = "code string, error long, label_error long, codebooks_sha256 string"


class Codebooks:
    """Entries (position, entry, component) of vectors of one length, in the order of their sums too."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        sums = entries.sum(axis=2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(entry, squared distance) of every vector's parts, ties to the lower entry, and how many distances were computed."""
        positions, size, width = self.entries.shape
        parts = vectors.reshape(len(vectors) * positions, width)
        where = np.tile(np.arange(positions), len(vectors))
        own = parts.sum(axis=1)
        high = np.empty(len(parts), np.int64)
        for p in range(positions):
            high[p::positions] = np.searchsorted(self.sums[p], own[p::positions])
        low = high - 1
        best = np.full(len(parts), -1, np.int64)
        code = np.zeros(len(parts), np.int64)
        open_, compared = np.arange(len(parts)), 0
        never = np.iinfo(np.int64).max
        while len(open_):
            at, left, right = where[open_], low[open_], high[open_]
            gap_left = np.where(left >= 0, own[open_] - self.sums[at, np.maximum(left, 0)], never)
            gap_right = np.where(right < size, self.sums[at, np.minimum(right, size - 1)] - own[open_], never)
            gap = np.minimum(gap_left, gap_right)
            going = gap < never
            going &= (best[open_] < 0) | (np.where(going, gap, 0) ** 2 <= best[open_] * width)
            open_, at, down = open_[going], at[going], (gap_left <= gap_right)[going]
            entry = self.order[at, np.where(down, left[going], right[going])]
            distance = squared(parts[open_] - self.entries[at, entry])
            better = (best[open_] < 0) | (distance < best[open_]) | ((distance == best[open_]) & (entry < code[open_]))
            best[open_[better]], code[open_[better]] = distance[better], entry[better]
            low[open_[down]] -= 1
            high[open_[~down]] += 1
            compared += len(open_)
        return code.reshape(-1, positions), best.reshape(-1, positions), compared

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _by_length(batch: pa.RecordBatch):
    """(length, rows, vectors) of a batch's vectors of each length."""
    sizes = np.diff(np.asarray(batch.column(2).offsets))
    for n in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == n)
        yield n, rows, matrix(batch.column(2).take(pa.array(rows)), n) if n else np.zeros((len(rows), 0), np.int64)


def first_books(kept: DataFrame, n: int) -> Codebooks:
    """Of vectors of length n: the parts of those with the smallest ids (of equal ids the smaller vector first, null ids last)."""
    own = kept.filter(F.size("v") == n).select("_id", "v")
    rows = smallest(own, [F.col("_id").asc_nulls_last(), F.col("v").asc()], ENTRIES).collect()
    vectors = np.array([row["v"] for row in rows], np.int64).reshape(len(rows), PARTS, n // PARTS)
    return Codebooks(vectors.transpose(1, 0, 2).copy())


def _refitted(kept: DataFrame, books: dict[int, Codebooks]) -> dict[int, Codebooks]:
    """Every entry that codes a part replaced by its parts' componentwise floor(sum / count)."""

    def added(batches):
        sums = {n: np.zeros((*b.entries.shape[:2], b.entries.shape[2] + 1), np.int64) for n, b in books.items()}
        for batch in batches:
            for n, _, x in _by_length(batch):
                code = books[n].nearest(x)[0]
                parts = x.reshape(len(x), PARTS, n // PARTS)
                for p in range(PARTS):
                    np.add.at(sums[n][p, :, :-1], code[:, p], parts[:, p])
                    sums[n][p, :, -1] += np.bincount(code[:, p], minlength=sums[n].shape[1])
        for n, own in sums.items():
            cells = np.flatnonzero(own.ravel())
            yield pa.RecordBatch.from_arrays([longs(np.full(len(cells), n)), longs(cells), longs(own.ravel()[cells])], ["n", "cell", "total"])

    found = totals(kept.mapInArrow(added, "n long, cell long, total long"), ["n", "cell"])
    new = {}
    for n, book in books.items():
        p, e, w = book.entries.shape
        sums = np.array([found.get((n, cell), 0) for cell in range(p * e * (w + 1))], object).reshape(p, e, w + 1)
        used = sums[:, :, -1] > 0
        entries = book.entries.copy()
        entries[used] = (sums[used][:, :-1] // sums[used][:, -1:]).astype(np.int64)
        new[n] = Codebooks(entries)
    return new


def encode(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, dict[int, Codebooks]]:
    """(_id, _label, length, code, error) of every kept vector as a written table, and the codebooks by vector length.

    Vectors that are null or hold null or non-finite components are dropped, and so are
    those that can't be cut into PARTS equal parts.  Vectors of different lengths share
    no codebook: each length has its own, from its own smallest ids (lengths are taken
    to be few; usually there is one).  Fewer vectors than ENTRIES make fewer entries.
    Repeated rows are coded each for itself.  Other columns are not read.
    """
    kept = whole_numbers(vectors, vec_col, SCALE, F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    kept = written(kept.filter(F.size("v") % PARTS == 0), "code-vectors")
    lengths = [row["n"] for row in kept.groupBy(F.size("v").alias("n")).count().orderBy("n").collect()]
    books = {n: first_books(kept, n) for n in lengths}
    for _ in range(rounds):
        books = _refitted(kept, books)
    final = books

    def coded(batches):
        for batch in batches:
            codes, errors = np.empty(len(batch), object), np.zeros(len(batch), np.int64)
            lengths = np.diff(np.asarray(batch.column(2).offsets))
            for n, rows, x in _by_length(batch):
                code, error, _ = final[n].nearest(x)
                codes[rows] = [c.tobytes().hex() for c in code.astype(np.uint8)]
                errors[rows] = error.sum(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], longs(lengths), strings(codes.tolist()), longs(errors)], ["_id", "_label", "length", "code", "error"])

    kinds = [kept.schema[name].dataType.simpleString() for name in ("_id", "_label")]
    found = kept.mapInArrow(coded, f"_id {kinds[0]}, _label {kinds[1]}, length long, code string, error long")
    return written(found, "code-found"), books


def report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per kept vector: vec_id, code, error, the error summed over equal labels (nulls together), its codebooks' digest.

    No kept vector, an empty table included: no row.
    """
    spark = vectors.sparkSession
    found, books = encode(vectors, id_col, vec_col, label_col)
    if not books:
        return spark.createDataFrame([], f"vec_id {vectors.schema[id_col].dataType.simpleString()}, {SCHEMA}")
    by_label = found.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    by_label = small_side(written(by_label, "code-labels"))
    digests = inline_table(spark, "_n, codebooks_sha256", [(n, book.digest()) for n, book in books.items()])
    joined = found.join(by_label, F.col("_label").eqNullSafe(F.col("_of"))).join(F.broadcast(digests), F.col("length") == F.col("_n"))
    return joined.select(F.col("_id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = ROUNDS) -> str:
    """Every part compared with all entries; for tables of one vector length."""
    made = [
        f"""kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM kept, range({PARTS}) r(p)
)""",
        f"""b0 AS (
  SELECT p, CAST(row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS BIGINT) AS e, x FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= {ENTRIES}
)""",
    ]
    for r in range(rounds + 1):
        made.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x, min(d * {ENTRIES} + e) % {ENTRIES} AS e, min(d) AS d FROM (
    SELECT t.vec_id, t.label, t.p, t.x, b.e, CAST(list_sum(list_transform(list_zip(t.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts t JOIN b{r} b ON t.p = b.p
  ) GROUP BY vec_id, p
)"""
        )
        if r < rounds:
            made.append(
                f"""m{r} AS (
  SELECT p, e, list(y ORDER BY j) AS x FROM (
    SELECT p, e, j, CAST(floor(sum(y) / count(*)) AS BIGINT) AS y FROM (SELECT p, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{r}) GROUP BY p, e, j
  ) GROUP BY p, e
), b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN m{r} m ON b.p = m.p AND b.e = m.e)"""
            )
    return f"""
WITH {", ".join(made)},
coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded
"""


SQL = _sql()
