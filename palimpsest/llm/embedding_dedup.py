"""Embedding near-dedup by a forest of random-projection trees.

A tree splits the vectors again and again at the middle of a random projection; those
near the middle go to both sides.  Vectors that share a leaf of any tree are compared
in double precision; linked ones are united, and each component's links are counted
by comparing its members.

Trees are fitted on a bounded sample and every vector is routed through all of them.
Equal vectors are one class with a count, so they never fill a leaf.  A component's
members inside a ball so narrow that all of them must be linked are counted, not
compared; only the others meet all members, in blocks of bounded size.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import blobs, components, longs, table, thinned
from palimpsest.session import written

COSINE = 0.9
TREES = 10
LEAF = 256
#: Share of a node's vectors on either side of its middle that go both ways.
SPILL = 0.04
#: Where SPILL of normal values end, in deviations from the middle.
BAND = 0.1004
#: Trees are fitted on at most so many vectors, to at most so many levels; deeper levels split by
#: shared directions around each learned leaf's centre, with the same overlap by its spread.
SAMPLE = 40_000
LEARNED_LEVELS = 11
BLOCK = 1024
#: Vectors this near to a centre are within half the linking angle: each pair of them is linked.
BALL = math.cos(math.acos(COSINE) / 2) + 1e-9


class Tree:
    """Splits as a heap: plane, and the two cuts between which vectors go both ways."""

    def __init__(self, x: np.ndarray, levels: int, rng: np.random.Generator):
        dim = x.shape[1]
        self.levels = min(levels, LEARNED_LEVELS)
        nodes = (1 << self.levels) - 1
        self.planes = rng.normal(size=(nodes, dim)).astype(np.float32)
        self.low, self.high = np.zeros(nodes, np.float32), np.zeros(nodes, np.float32)
        self.centres = np.zeros((nodes + 1, dim), np.float32)
        self.spread = np.zeros(nodes + 1, np.float32)
        self.more = rng.normal(size=(max(0, levels - self.levels), dim)).astype(np.float32)
        parts = {0: np.arange(len(x))}
        for node in range(nodes):
            own = parts.pop(node)
            if len(own) > 1:
                a, b = rng.choice(own, 2, replace=False)
                if np.abs(x[a] - x[b]).max() > 1e-6:
                    self.planes[node] = x[a] - x[b]
            along = x[own] @ self.planes[node]
            if len(own):
                self.low[node], middle, self.high[node] = np.quantile(along, [0.5 - SPILL, 0.5, 0.5 + SPILL])
                sides = own[along <= middle], own[along > middle]
            else:
                sides = own, own
            for side, rows in enumerate(sides):
                child = 2 * node + 1 + side
                if child < nodes:
                    parts[child] = rows
                elif len(rows):
                    self.centres[child - nodes] = x[rows].mean(axis=0)
                    self.spread[child - nodes] = np.sqrt(((x[rows] - self.centres[child - nodes]) ** 2).mean())
        # a leaf of one vector or none says nothing about its spread
        self.spread[self.spread == 0] = self.spread[self.spread > 0].mean() if (self.spread > 0).any() else 0

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every vector, once or more."""
        rows = np.arange(len(x))
        at = np.zeros(len(x), np.int64)
        for _ in range(self.levels):
            along = np.einsum("ij,ij->i", x[rows], self.planes[at])
            left, right = along <= self.high[at], along > self.low[at]
            rows, at = np.concatenate([rows[left], rows[right]]), np.concatenate([2 * at[left] + 1, 2 * at[right] + 2])
        at -= (1 << self.levels) - 1
        leaf = at
        for plane in self.more:
            along = (x[rows] - self.centres[at]) @ plane
            band = BAND * self.spread[at] * np.linalg.norm(plane)
            left, right = along <= band, along > -band
            rows, at = np.concatenate([rows[left], rows[right]]), np.concatenate([at[left], at[right]])
            leaf = np.concatenate([2 * leaf[left], 2 * leaf[right] + 1])
        return rows, leaf


def trees_for(levels: int, trees: int = TREES) -> int:
    """More trees as they get deeper: each level may part a pair, and what one tree parts another holds."""
    return trees + max(0, levels - LEARNED_LEVELS)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in column), np.float64).reshape(len(column), -1)


def _units(column) -> np.ndarray:
    x = np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """A leaf's vectors, each with the smallest one of its component in the leaf."""
    frame = frame.sort_values("cid", ignore_index=True)
    x = _units(frame["vec"])
    cid = frame["cid"].to_numpy()
    label = np.arange(len(x))
    while True:
        new = label.copy()
        for a in range(0, len(x), BLOCK):
            for b in range(0, len(x), BLOCK):
                near = x[a : a + BLOCK] @ x[b : b + BLOCK].T >= COSINE
                new[a : a + BLOCK] = np.minimum(new[a : a + BLOCK], np.where(near, label[b : b + BLOCK], len(x)).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(x))
    return pd.DataFrame({"u": cid[moved], "v": cid[label[moved]]})


def _counted(frame: pd.DataFrame) -> pd.DataFrame:
    """Links between a block of loose members and a block of all members of a component."""
    loose, all_ = frame[frame["loose_side"]], frame[~frame["loose_side"]]
    if not len(loose) or not len(all_):
        return pd.DataFrame({"cid": [], "links": []}).astype("int64")
    x, y = _units(loose["vec"]), _units(all_["vec"])
    near = (x @ y.T >= COSINE) & (loose["cid"].to_numpy()[:, None] != all_["cid"].to_numpy()[None, :])
    tight = ~all_["loose"].to_numpy()
    return pd.DataFrame(
        {
            "cid": np.concatenate([loose["cid"], all_["cid"][tight]]),
            "links": np.concatenate([near @ all_["copies"].to_numpy(), (near.T @ loose["copies"].to_numpy())[tight]]),
        }
    )


def forest(vectors: DataFrame, count: int, trees: int, leaf: int) -> list[Tree]:
    named = vectors.withColumn("_o", F.xxhash64("cid", F.lit(5)))
    few = thinned(named, "_o", SAMPLE, 1.2)
    sample = (named if few is None else few).orderBy("_o").limit(SAMPLE).select("vec").toArrow().column("vec").combine_chunks()
    x = _matrix(sample)
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    levels = max(0, math.ceil(math.log2(max(1, count) / leaf)))
    return [Tree(x, levels, np.random.default_rng(100 + k)) for k in range(trees_for(levels, trees))]


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, leaf: int = LEAF
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, zero, or hold null or non-finite components link with nothing;
    vectors of different lengths have no cosine: each length has a forest of its own
    (lengths are taken to be few; usually there is one).  Copies and repeated rows link
    with each other.  component_id is the smallest id in the component that is not null;
    kept tells whether that is the row's own.
    """
    given = vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0), F.lit(False))
    # the length is part of the name: names of different lengths never meet
    given = given.select("_id", F.when(fine, F.xxhash64(F.size("v"), "v")).alias("cid"), F.when(fine, F.col("v")).alias("v"))
    lengths = sorted(row["n"] for row in given.filter("cid IS NOT NULL").groupBy(F.size("v").alias("n")).count().collect())
    if not lengths:
        return given.select(F.col("_id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    parts = [_linked(given.filter(F.size("v") == n), trees, leaf) for n in lengths]
    copies, links = (reduce(DataFrame.unionAll, [part[k] for part in parts]) for k in (0, 1))
    light = given.select("_id", "cid").join(copies, "cid", "left").join(links, "cid", "left")
    light = light.withColumn("component", F.coalesce("component", "cid"))
    tops = light.filter("component IS NOT NULL").groupBy("component").agg(F.min("_id").alias("top"))
    return light.join(tops, "component", "left").select(
        F.col("_id").alias("vec_id"),
        F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("top", "_id").alias("component_id"),
        F.coalesce(F.col("_id") == F.col("top"), F.lit(True)).alias("kept"),
    )


def _linked(given: DataFrame, trees: int, leaf: int) -> tuple[DataFrame, DataFrame]:
    """Of vectors of one length: (cid, copies) of the classes, (cid, component, links) of those that link with others."""
    spark = given.sparkSession

    def packed(batches):
        for batch in batches:
            lists = batch.column(0)
            x = np.asarray(lists.flatten()).astype(np.float64).reshape(len(batch), -1)
            # any scale of a vector is the same vector; large ones would overflow a norm
            x = x / np.abs(x).max(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), blobs([r.tobytes() for r in x])], ["cid", "copies", "vec"])

    counted = given.filter("cid IS NOT NULL").groupBy("cid").agg(F.first("v").alias("v"), F.count("*").alias("copies"))
    classes = written(counted.select("v", "cid", "copies").mapInArrow(packed, "cid long, copies long, vec binary"), "vectors")
    count = classes.count()
    sent = spark.sparkContext.broadcast(forest(classes, count, trees, leaf))

    def routed(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            unit = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
            for k, tree in enumerate(sent.value):
                rows, at = tree.leaves(unit)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), k, np.int32)), longs(at), batch.column(0).take(take), batch.column(1).take(take)],
                    ["tree", "leaf", "cid", "vec"],
                )

    leaves = classes.select("cid", "vec").mapInArrow(routed, "tree int, leaf long, cid long, vec binary")
    edges = leaves.groupBy("tree", "leaf").applyInPandas(_compared, "u long, v long")
    grouped = components(edges, "vector-components")
    members = written(classes.join(grouped, classes["cid"] == grouped["node"]).select("cid", "copies", "vec", "component"), "vector-members")
    return classes.select("cid", "copies"), _links(members)


def _links(members: DataFrame) -> DataFrame:
    """(cid, component, links): copies of other classes linked with each class, its own copies aside."""
    centre = written(_centres(members), "vector-centres")

    def marked(batches):
        for batch in batches:
            x, c = _matrix(batch.column(2)), _matrix(batch.column(4))
            cos = (x * c).sum(axis=1) / np.linalg.norm(x, axis=1) / np.maximum(np.linalg.norm(c, axis=1), 1e-300)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(cos < BALL)], ["cid", "copies", "vec", "component", "loose"])

    placed = members.join(centre, "component").select("cid", "copies", "vec", "component", "centre")
    placed = written(placed.mapInArrow(marked, "cid long, copies long, vec binary, component long, loose boolean"), "vector-placed")
    sizes = placed.groupBy("component").agg(
        F.count("*").alias("n"), F.count_if("loose").alias("n_loose"), F.sum(F.when(~F.col("loose"), F.col("copies")).otherwise(0)).alias("tight")
    )
    placed = placed.join(sizes, "component")
    slot = lambda n, seed: F.pmod(F.xxhash64("cid", F.lit(seed)), F.ceil(F.col(n) / BLOCK))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col(n) / BLOCK) - 1))
    open_ = placed.filter("n_loose > 0")
    blocks = open_.select("component", slot("n", 1).alias("a"), each("n_loose").alias("b"), "cid", "copies", "vec", "loose", F.lit(False).alias("loose_side"))
    blocks = blocks.unionAll(
        open_.filter("loose").select("component", each("n").alias("a"), slot("n_loose", 2).alias("b"), "cid", "copies", "vec", "loose", F.lit(True).alias("loose_side"))
    )
    found = blocks.groupBy("component", "a", "b").applyInPandas(_counted, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("found"))
    sure = F.when(F.col("loose"), 0).otherwise(F.col("tight") - F.col("copies"))
    return placed.join(found, "cid", "left").select("cid", "component", (sure + F.coalesce("found", F.lit(0))).alias("links"))


def _centres(members: DataFrame) -> DataFrame:
    """(component, centre): the sum of the unit vectors, added up per task first."""

    def summed(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = _matrix(batch.column(1))
            x = x / np.linalg.norm(x, axis=1)[:, None]
            for c, v in zip(batch.column(0).to_pylist(), x, strict=True):
                held[c] = held[c] + v if c in held else v
            if len(held) > 100_000:
                yield _held(held)
                held = {}
        if held:
            yield _held(held)

    def _held(held):
        return pa.RecordBatch.from_arrays([longs(list(held)), blobs([v.tobytes() for v in held.values()])], ["component", "centre"])

    def added(frame):
        total = np.sum([np.frombuffer(v, np.float64) for v in frame["centre"]], axis=0)
        return pd.DataFrame({"component": [frame["component"].iloc[0]], "centre": [total.tobytes()]})

    kind = "component long, centre binary"
    return members.select("component", "vec").mapInArrow(summed, kind).groupBy("component").applyInPandas(added, kind)


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
