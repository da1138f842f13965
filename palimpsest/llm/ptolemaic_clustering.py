"""Centroid clustering that skips distances by Ptolemy's inequality.

For any four points, d(x, c) * d(p, s) >= |d(x, p) * d(c, s) - d(x, s) * d(c, p)|.  The
distances of every vector to a few fixed pivot pairs (p, s) are computed once and kept
beside it; a round computes those of the centroids, and each pair then bounds every
vector's distance to every centroid from below without reading the vector.  Bounds are
rounded down by more than the arithmetic can err; a centroid whose bound lies beyond the
best distance so far is skipped, and every other one is checked by exact integers, so
the result is that of the full comparison.

A round is one pass over the written vectors: tasks send each centroid's sums, never a
vector, and centroids are as few as asked for.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import blobs, longs, table
from palimpsest.llm.lattice import matrix, smallest, squared, totals, whole_numbers
from palimpsest.session import inline_table, written

DIM = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
#: Pivot pairs, chosen among so many vectors.
PAIRS = 4
CANDIDATES = 64
#: More than the relative error of a bound's few products, quotients and roots.
SLACK = 1e-13

SCHEMA = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


@dataclass(frozen=True)
class Pivots:
    """Pairs of points and the distance within each pair."""

    first: np.ndarray
    second: np.ndarray
    apart: np.ndarray

    @classmethod
    def among(cls, points: np.ndarray, pairs: int = PAIRS) -> Pivots:
        """The widest pairs, no point twice (ties: the earlier points)."""
        wide = [(-int(squared(points[i : i + 1] - points[j : j + 1])[0]), i, j) for i in range(len(points)) for j in range(i)]
        used: set[int] = set()
        taken = []
        for gap, i, j in sorted(wide):
            if gap and len(taken) < pairs and not {i, j} & used:
                used |= {i, j}
                taken.append((i, j))
        one, two = ([t[side] for t in taken] for side in (0, 1))
        return cls(points[one], points[two], np.sqrt(squared(points[one] - points[two]).astype(np.float64)))

    def cached(self, x: np.ndarray) -> np.ndarray:
        """Distances of each row to all first, then all second points."""
        ends = np.concatenate([self.first, self.second])
        found = np.empty((len(x), len(ends)))
        for k, end in enumerate(ends):
            found[:, k] = np.sqrt(squared(x - end).astype(np.float64))
        return found

    def below(self, near_x: np.ndarray, near_c: np.ndarray) -> np.ndarray:
        """A lower bound of every squared distance between rows and centroids, from their cached distances."""
        best = np.zeros((len(near_x), len(near_c)))
        n = len(self.apart)
        for k in range(n):
            one = np.outer(near_x[:, k], near_c[:, n + k])
            two = np.outer(near_x[:, n + k], near_c[:, k])
            gap = np.abs(one - two) - SLACK * (one + two)
            np.maximum(best, gap / self.apart[k], out=best)
        return np.floor(best * best * (1 - SLACK))


def assign(x: np.ndarray, near_x: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each row, ties to the smaller number, and how many distances were computed."""
    bound = pivots.below(near_x, pivots.cached(centroids))
    start = bound.argmin(axis=1) if len(x) else np.zeros(0, np.int64)
    cluster, best = start.copy(), squared(x - centroids[start])
    compared = len(x)
    for c in range(len(centroids)):
        rows = np.flatnonzero((bound[:, c] <= best) & (start != c))
        compared += len(rows)
        found = squared(x[rows] - centroids[c])
        better = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        cluster[rows[better]], best[rows[better]] = c, found[better]
    return cluster, best, compared


def seeds(rows: DataFrame, n: int) -> np.ndarray:
    """The n vectors with the smallest sha256 of `1:<id>`, in that order; of equal ids the smaller vector first, null ids last."""
    named = rows.withColumn("_hash", F.sha2(F.concat(F.lit("1:"), F.col("_id").cast("string")), 256))
    first = smallest(named.select("_hash", "v"), [F.col("_hash").asc_nulls_last(), F.col("v").asc()], n).collect()
    return np.array([row["v"] for row in first], np.int64)


@dataclass(frozen=True)
class Clustering:
    """rows: _id, cluster, distance (a written table); the final centroids."""

    rows: DataFrame
    centroids: np.ndarray


def cluster(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE
) -> Clustering | None:
    """k centroids after so many rounds, and every kept vector's nearest one; None if no vector is kept.

    Kept are vectors with exactly `dim` components, none null or non-finite.  Repeated
    rows count each for itself; fewer vectors than k make fewer centroids.  A centroid
    without vectors stays as it is.  Only the two named columns are read.
    """
    spark = vectors.sparkSession
    kept = whole_numbers(vectors.filter(F.size(vec_col) == dim), vec_col, scale, F.col(id_col).alias("_id"))
    kept = written(kept, "cluster-vectors")
    chosen = seeds(kept, max(k, CANDIDATES))
    if not len(chosen):
        return None
    centroids, pivots = chosen[:k], Pivots.among(chosen)

    def measured(batches):
        for batch in batches:
            near = pivots.cached(matrix(batch.column(1), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, blobs([row.tobytes() for row in near])], ["_id", "v", "near"])

    kind = kept.schema["_id"].dataType.simpleString()
    kept = written(kept.mapInArrow(measured, f"_id {kind}, v array<int>, near binary"), "cluster-measured")
    width = 2 * len(pivots.apart)

    def placed(batch, centroids):
        x = matrix(batch.column(1), dim)
        near = np.frombuffer(b"".join(v.as_buffer() for v in batch.column(2)), np.float64).reshape(len(x), width)
        return x, *assign(x, near, centroids, pivots)[:2]

    for _ in range(rounds):
        centroids = _moved(kept, centroids, placed)
    final = centroids

    def last(batches):
        for batch in batches:
            _, at, distance = placed(batch, final)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32)), longs(distance)], ["_id", "cluster", "distance"])

    found = kept.mapInArrow(last, f"_id {kind}, cluster int, distance long")
    return Clustering(written(found, "cluster-found"), centroids)


def _moved(rows: DataFrame, centroids: np.ndarray, placed) -> np.ndarray:
    """Every centroid with vectors replaced by their componentwise floor(sum / count)."""
    k, dim = centroids.shape

    def added(batches):
        sums = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            x, at, _ = placed(batch, centroids)
            for c in np.unique(at):
                own = x[at == c]
                sums[c, :dim] += own.sum(axis=0)
                sums[c, dim] += len(own)
        cells = np.flatnonzero(sums.ravel())
        yield pa.RecordBatch.from_arrays([longs(cells), longs(sums.ravel()[cells])], ["cell", "total"])

    found = totals(rows.mapInArrow(added, "cell long, total long"), ["cell"])
    new = centroids.copy()
    for c in range(k):
        if count := found.get((c * (dim + 1) + dim,), 0):
            new[c] = [found.get((c * (dim + 1) + j,), 0) // count for j in range(dim)]
    return new


def report(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **settings) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, the distances' sums by cluster and over all, the centroid's digest.

    No kept vector, an empty table included: no row.
    """
    spark = vectors.sparkSession
    made = cluster(vectors, id_col, vec_col, **settings)
    if made is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, {SCHEMA}")
    sums = totals(made.rows.select("cluster", F.col("distance").alias("total")), ["cluster"])
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in made.centroids]
    facts = [(c, sums.get((c,), 0), sum(sums.values()), digest[c]) for c in range(len(digest))]
    facts = inline_table(spark, "c, cluster_inertia, inertia, centroid_sha256", facts)
    joined = made.rows.join(F.broadcast(facts), F.col("cluster") == F.col("c"))  # as many rows as centroids
    return joined.select(
        F.col("_id").alias("vec_id"), "cluster", "distance",
        F.col("cluster_inertia").cast("long").alias("cluster_inertia"), F.col("inertia").cast("long").alias("inertia"), "centroid_sha256",
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "embeddings"))


def _sql(rounds: int = ROUNDS) -> str:
    """The full comparison, round by round."""
    parts = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS c, v FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id)) <= {CLUSTERS}
)""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT k.vec_id, k.v, c.c, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
  FROM kept k CROSS JOIN c{r} c QUALIFY row_number() OVER (PARTITION BY k.vec_id ORDER BY d, c.c) = 1
)"""
        )
        if r < rounds:
            parts.append(
                f"""m{r} AS (
  SELECT c, list(x ORDER BY j) AS v FROM (
    SELECT c, j, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{r}) GROUP BY c, j
  ) GROUP BY c
), c{r + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (c))"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, a.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.c = c.c
"""


SQL = _sql()
