"""What must not change with size or shape: deep trees, mixed vector lengths, anchors, bounded samples."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import common, embedding_dedup, suffix_dedup


def pairs_at(cosine, n, dim, rng):
    a = rng.normal(size=(n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = rng.normal(size=(n, dim))
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    return a.astype(np.float32), (cosine * a + math.sqrt(1 - cosine**2) * b).astype(np.float32)


@pytest.mark.parametrize("levels", [9, 13])
def test_recall_of_deep_trees(levels, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LEARNED_LEVELS", 7)  # six levels beyond the learned ones, as 17 are beyond 11
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 48))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    a, b = pairs_at(0.905, 400, 48, rng)
    hit = np.zeros(400, bool)
    for k in range(embedding_dedup.trees_for(levels)):
        tree = embedding_dedup.Tree(x, levels, np.random.default_rng(100 + k))
        (r1, l1), (r2, l2) = tree.leaves(a), tree.leaves(b)
        assert l1.max() < 1 << levels and set(r1) == set(range(400))
        mine = set(zip(r1.tolist(), l1.tolist(), strict=True))
        hit[[r for r, leaf in zip(r2.tolist(), l2.tolist(), strict=True) if (r, leaf) in mine]] = True
    assert hit.mean() >= 0.97


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=16).tolist()) for k in range(40)]
    rows += [(100 + k, rows[k][1]) for k in range(3)]  # copies
    rows += [(200 + k, (np.array(rows[k][1]) * (1 + 0.01 * (np.arange(16) % 2))).tolist()) for k in range(3)]  # near copies
    rows += [(300, [1.0, 2.0]), (301, [2.0, 4.0]), (302, [1.0, 2.0]), (303, [-1.0, 2.0]), (304, [0.0, 0.0]), (305, [5.0]), (306, None), (307, [float("nan")] * 16)]
    expected, groups = {}, {k: k for k, _ in rows}

    def cosine(v, w):
        if v is None or w is None or len(v) != len(w) or not np.isfinite(v + w).all() or not any(v) or not any(w):
            return -1
        return float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w))

    for i, v in rows:
        near = [j for j, w in rows if i != j and cosine(v, w) >= 0.9]
        expected[i] = len(near)
        for j in near:
            old, new = max(groups[i], groups[j]), min(groups[i], groups[j])
            groups = {k: new if g == old else g for k, g in groups.items()}
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {k: (expected[k], groups[k]) for k in expected}


@pytest.mark.parametrize("data", [np.tile(np.arange(97, 134, dtype=np.uint8), 60), np.full(3000, 97, np.uint8), np.random.default_rng(0).integers(97, 100, 4000).astype(np.uint8)])
def test_equal_windows_have_equal_anchors(data):
    names = suffix_dedup.Names(data)
    at = suffix_dedup.anchors(names, len(data)) - np.arange(len(data) - suffix_dedup.LENGTH + 1)
    assert at.min() >= 0 and at.max() <= suffix_dedup.LENGTH - suffix_dedup.GRAM
    seen = {}
    for k, offset in enumerate(at.tolist()):
        assert seen.setdefault(data[k : k + suffix_dedup.LENGTH].tobytes(), offset) == offset


def test_samples_are_the_smallest_hashes_whatever_the_size(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("_text"))
    keys = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("y"), F.xxhash64("id", F.lit(5)).alias("_o"))
    whole = [r["_text"] for y in (0, 1) for r in keys.filter(F.col("y") == y).join(docs, "doc_id").orderBy("_o").limit(20).collect()]
    rows = common.sampled(keys, lambda some: docs.join(some, "doc_id"), {0: 20, 1: 20})
    assert rows.column("_text").to_pylist() == whole
    # where what makes a row drops most keys, more of them are taken
    rare = common.sampled(keys, lambda some: docs.filter("doc_id % 100 = 0").join(some, "doc_id"), {0: 20, 1: 20})
    assert rare.column("y").to_pylist() == [0] * 20
    assert common.thinned(keys, "_o", 20, 4.0).count() < 200 and common.thinned(keys, "_o", 2000, 4.0) is None
