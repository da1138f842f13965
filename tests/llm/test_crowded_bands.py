"""A crowd of near copies in one band: compared with a few of them, not each with all, and no link is lost."""

import numpy as np

from palimpsest.llm import paragraph_dedup
from palimpsest.session import written


def test_a_crowd_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [f"w{k}" for k in rng.permutation(60)]
    texts = []
    for k in range(240):  # one word changed: two of them link only where the places are close, or close to an end
        words = list(base)
        words[int(rng.integers(60))] = f"x{k}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = paragraph_dedup.keyed(frame, "doc_id", "text")
    found = written(paragraph_dedup.paragraphs(rows), "test-places")
    classes = paragraph_dedup.classes_of(found)
    sets = {r["cls"]: set(np.frombuffer(r["tokens"], np.uint64).tolist()) for r in paragraph_dedup._sets(rows, classes.select("cls", "at._k1", "at._k2")).collect()}
    keys = {r["cls"]: [r[name] for name in paragraph_dedup.KEYS] for r in classes.collect()}
    expected = {c: c for c in sets}
    for a, x in sets.items():
        for b, y in sets.items():
            meet = a < b and any(k == m for k, m in zip(keys[a], keys[b], strict=True))
            if meet and len(x & y) >= paragraph_dedup.SIMILAR * len(x | y) and expected[a] != expected[b]:
                old, new = max(expected[a], expected[b]), min(expected[a], expected[b])
                expected = {c: new if g == old else g for c, g in expected.items()}
    compared = []

    def noted(df, label, *more):
        out = written(df, label, *more)
        if label in ("paragraph-again", "paragraph-tried"):
            compared.append(out.count())
        return out

    monkeypatch.setattr(paragraph_dedup, "written", noted)
    got = dict(tuple(r) for r in paragraph_dedup.components(paragraph_dedup.linked(rows, classes)).collect())
    assert {c: got.get(c, c) for c in sets} == expected
    assert sum(compared) < 10 * len(texts), compared
