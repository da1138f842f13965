import random

import pytest

from palimpsest.operators import needles
from palimpsest.session import BROADCAST_BYTES_CONF

ALPHABET = "abAB1.@é \n\"]"


def brute(texts, patterns):
    return [
        (i, p)
        for i, (a, b) in enumerate(texts)
        for p in patterns
        if any(t is not None and all(x in t for x in p if x is not None) for t in (a, b))
    ]


def found(spark, texts, patterns):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(texts)], "i int, a string, b string")
    pats = spark.createDataFrame(patterns, "needle string, also1 string, also2 string")
    hits = needles.search(df, ["a", "b"], needles.prepare(pats))
    return [(r["i"], (r["needle"], r["also1"], r["also2"])) for r in hits.collect()]


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("seed", range(3))
def test_same_as_nested_loop(spark, seed, limit):
    rng = random.Random(seed)

    def word(lo, hi):
        return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(lo, hi)))

    base = [word(1, 30) for _ in range(60)]
    texts = [
        (
            word(0, 10) + rng.choice(base) + word(0, 5) + rng.choice(base) if rng.random() < 0.9 else None,
            rng.choice([None, "", word(0, 60)]),
        )
        for _ in range(120)
    ]
    patterns = {(b[: rng.randint(1, len(b))], None, None) for b in base}
    patterns |= {(rng.choice(base), rng.choice(base)[:3], None) for _ in range(20)}
    patterns |= {(rng.choice(base)[:4], rng.choice(base)[:2], rng.choice(base)[:1]) for _ in range(20)}
    patterns = sorted(patterns, key=repr)
    if limit is not None:
        spark.conf.set(BROADCAST_BYTES_CONF, str(limit))
    try:
        assert key(found(spark, texts, patterns)) == key(brute(texts, patterns))
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)


def test_addresses_inside_longer_ones(spark):
    texts = [("sandra.m@x.org", None), ("to: andra.m@x.org, b@c", None), ("andra_m@x.org", None), ("@", None)]
    patterns = [("andra.m@x.org", None, None), ("a@x", None, None), ("b@c", None, None), ("@", None, None)]
    assert key(found(spark, texts, patterns)) == key(brute(texts, patterns))


def test_crowded_prefix_uses_a_rarer_window(spark):
    pats = spark.createDataFrame([(f"Customer{i:06d}",) for i in range(500)], "needle string")
    anchors = [r["anchor"] for r in needles.prepare(pats).frame.collect()]
    assert max(anchors.count(a) for a in set(anchors)) <= 64


def test_no_needles(spark):
    assert found(spark, [("abc", "d")], [("", None, None)]) == []
