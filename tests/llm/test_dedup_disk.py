"""What the deduplications of texts put on disk: sets of candidates only, narrow paragraphs, dealt keys gone."""

import os

import numpy as np

from palimpsest.llm import jaccard_join, paragraph_dedup
from palimpsest.session import dropped, scratch_root, written

WORDS = np.array([f"{a}{b}" for a in "the of and tion ing her that was for with on at by from".split() for b in "is are be have not you she him".split()])


def text_of(rng, n):
    return " ".join(rng.choice(WORDS, n))


def below(root):
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(root) for name in names)


def test_only_sets_of_candidates_are_made(spark, monkeypatch):
    rng = np.random.default_rng(1)
    parts = [text_of(rng, 100) for _ in range(4)]
    texts = [" ".join(parts), *parts]  # they share shingles in their prefixes, but sizes rule every link out
    own = text_of(rng, 80)
    texts += [own, own.rsplit(" ", 1)[0] + " changed"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = []

    def noted(df, label, *more):
        out = written(df, label, *more)
        if label == "jaccard-sets":
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", noted)
    got = {r["_id"]: r["component_id"] for r in jaccard_join.grouped(frame).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5}
    assert sum(made) == 2, made


def test_sets_that_their_sketches_part_are_not_made(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, y, z, own = (text_of(rng, 60) for _ in range(4))
    # x is rarer than y and z, so it stands in both prefixes; the sizes allow a link, a third of the shingles is shared
    texts = [f"{x} {y}", f"{x} {z}", y, y, y, z, z, z, own, own.rsplit(" ", 1)[0] + " changed"]
    frame = spark.createDataFrame([*enumerate(texts), (8, own)], "doc_id long, text string")  # one row comes twice
    made = []

    def noted(df, label, *more):
        out = written(df, label, *more)
        if label == "jaccard-sets":
            made.append(out.select("cls").distinct().count())
        return out

    monkeypatch.setattr(jaccard_join, "written", noted)
    got = {r["_id"]: r["component_id"] for r in jaccard_join.grouped(frame).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 2, 4: 2, 5: 5, 6: 5, 7: 5, 8: 8, 9: 8}
    assert sum(made) == 2, made


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (0, 1, 5, 300, 5000)]
    sets += [u[len(u) // 4 :] for u in sets]
    bits = np.unpackbits(jaccard_join._sketches(sets).view(np.uint8), axis=1)
    assert bits.shape == (len(sets), 64 * jaccard_join.SKETCH) and not bits[0].any()
    for u, mine in zip(sets, bits, strict=True):
        for v, other in zip(sets, bits, strict=True):
            assert (mine != other).sum() <= len(np.setxor1d(u, v))


def test_paragraphs_of_distinct_texts_take_less_than_twice_their_bytes(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["\n".join(text_of(rng, 12) for _ in range(20)) for _ in range(1500)]
    texts.append(texts[0])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    root = scratch_root(spark).removeprefix("file://")
    before, most = below(root), [0]

    def noted(df, label, *more):
        out = written(df, label, *more)
        most[0] = max(most[0], below(root) - before)
        return out

    monkeypatch.setattr(paragraph_dedup, "written", noted)
    got = {r["doc_id"]: r["n_removed"] for r in paragraph_dedup.removed(frame).collect()}
    assert sorted(k for k, n in got.items() if n) in ([0], [1500])
    assert most[0] < 1.6 * sum(map(len, texts)), most[0] / sum(map(len, texts))


def test_dropped_scratch_is_gone_and_the_rest_stays(spark):
    one, two = (written(spark.range(10), label) for label in ("drop-one", "drop-two"))
    at = [name.removeprefix("file://").rsplit("/", 1)[0] for name in (one.inputFiles()[0], two.inputFiles()[0])]
    dropped(one)
    assert not os.path.exists(at[0]) and os.path.exists(at[1]) and two.count() == 10
