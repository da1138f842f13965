"""Clustering, product codes and the token store against brute force, and on odd rows and tables."""

import hashlib
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from palimpsest.llm import ptolemaic_clustering as clustering
from palimpsest.llm import token_store, vector_codes

tokens = pytest.importorskip("public_tokenizers")
VECTORS = "vec_id long, embedding array<double>, label int, v long, _id string, near int, cluster long"


def vectors(dim, seed=3, n=300):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    made = (centres[rng.integers(0, 9, n)] + rng.normal(size=(n, dim)) * 0.3).round(3)
    made[40:60] = made[40]  # a group of copies
    rows = [(k, [float(x) for x in v], k % 4 if k % 5 else None) for k, v in enumerate(made)]
    odd = [None, [], [None] * dim, [float("nan")] * dim, [1.0] * (dim - 1), [float("inf"), *[0.0] * (dim - 1)], [0.0] * dim]
    rows += [(1000 + k, v, 1) for k, v in enumerate(odd)]
    return rows + [(None, rows[0][1], None), rows[5], rows[5]]


@pytest.fixture(scope="module")
def table64(spark):
    rows = vectors(64)
    return rows, spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], VECTORS).repartition(5)


def floors(v, scale):
    return [int(np.floor(scale * x)) for x in v]


def fine(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_clustering(spark, table64):
    rows, df = table64
    kept = [(i, floors(v, 64)) for i, v, _ in rows if fine(v) and len(v) == 64]
    name = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:16]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(3):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(centroids)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in last:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    expected = Counter((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in last)
    assert Counter(tuple(r) for r in clustering.report(df).collect()) == expected
    assert clustering.report(df.limit(0)).count() == 0
    assert clustering.report(df.filter("vec_id < 3")).count() == 3  # fewer vectors than centroids


def test_bounds_skip_and_never_lie():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 8)) * 400
    x = np.floor(centres[rng.integers(0, 16, 2000)] + rng.normal(size=(2000, 8)) * 40).astype(np.int64)
    c = np.floor(centres).astype(np.int64)
    c[7] = c[3]  # a tie
    pivots = clustering.Pivots.among(x[:64])
    exact = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (pivots.below(pivots.cached(x), pivots.cached(c)) <= exact).all()
    at, distance, compared = clustering.assign(x, pivots.cached(x), c, pivots)
    assert (at == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert compared < 0.5 * exact.size
    same = np.repeat(x[:1], 5, axis=0)  # no pair apart: nothing can be skipped, and nothing is wrong
    none = clustering.Pivots.among(same)
    assert clustering.assign(same, none.cached(same), c, none)[2] == 5 * 16


def test_codes(spark, table64):
    rows, df = table64
    rows = [r for r in rows if fine(r[1]) and len(r[1]) % 16 == 0]
    expected = Counter()
    errors, found = Counter(), []
    for n in {len(v) for _, v, _ in rows}:
        own = [(i, np.array(floors(v, 256), np.int64).reshape(16, n // 16), label) for i, v, label in rows if len(v) == n]
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[1].ravel().tolist()))[:64]
        books = np.array([r[1] for r in first]).transpose(1, 0, 2).copy()
        near = lambda v: [min((int(((v[p] - e) ** 2).sum()), k) for k, e in enumerate(books[p])) for p in range(16)]  # noqa: B023, E731
        for _ in range(2):
            groups = defaultdict(list)
            for _, v, _ in own:
                for p, (_, k) in enumerate(near(v)):
                    groups[p, k].append(v[p])
            for (p, k), parts in groups.items():
                books[p, k] = np.sum(parts, axis=0) // len(parts)
        digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
        for i, v, label in own:
            got = near(v)
            errors[label] += sum(d for d, _ in got)
            found.append((i, "".join(f"{k:02x}" for _, k in got), sum(d for d, _ in got), label, digest))
    expected = Counter((i, code, error, errors[label], digest) for i, code, error, label, digest in found)
    assert Counter(tuple(r) for r in vector_codes.report(df).collect()) == expected
    assert vector_codes.report(df.limit(0)).count() == 0


def test_equal_average_search_skips():
    rng = np.random.default_rng(8)
    entries = rng.integers(-300, 300, (16, 64, 4))
    entries[:, 9] = entries[:, 2]  # ties
    x = rng.integers(-300, 300, (200, 64))
    parts = x.reshape(200, 16, 4)
    exact = ((parts[:, :, None] - entries[None]) ** 2).sum(axis=3)
    code, distance, compared = vector_codes.Codebooks(entries).nearest(x)
    assert (code == exact.argmin(axis=2)).all() and (distance == exact.min(axis=2)).all()
    assert compared < 0.7 * exact.size


def test_too_large_components_stop(spark):
    df = spark.createDataFrame([(1, [1e300] * 64, 0)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        clustering.report(df).count()


# ---------------------------------------------------------------- token store

WORDS = "The quick brown fox's jumps, over 1234 lazy dogs! café CAFÉ é naïve straße İstanbul 東京 ́x don't ΣΑΣ".split(" ")
SPACES = [" ", "\n", "\t\t", " \r\n", " ", " ", "\x85", "\x1c", "\x0b", "​", ""]


def text(seed, n=40):
    rng = np.random.default_rng(seed)
    return "".join(WORDS[a] + SPACES[b] for a, b in zip(rng.integers(0, len(WORDS), n), rng.integers(0, len(SPACES), n), strict=True))


TEXTS = [(k, text(k)) for k in range(200)] + [(7, text(1)), (7, text(1)), (7, text(2)), (300, None), (301, ""), (302, " \n "), (303, text(9, 30_000)), (None, "null id"), (None, "null id")]
TEXTS += [(400, "one text in many copies")] * 300 + [(304, "a <|endoftext|> <|startoftext|>b"), (305, "x" * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "y", 2) for i, t in TEXTS], "doc_id long, text string, shard long, value string, copy long").repartition(4)


@pytest.fixture(scope="module")
def store(spark, docs, tmp_path_factory):
    return token_store.write(docs, str(tmp_path_factory.mktemp("store")), tokens.path("word_bpe_49k.json"), shard_bytes=20_000, part_keys=50)


def encoded(name="word_bpe_49k.json"):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.path(name))
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]


def test_store_keeps_every_id(spark, docs, store):
    code = encoded()
    assert store.width == 2 and store.parts > 5
    files = sorted(__import__("pathlib").Path(store.root, "shards").glob("part-*"))
    sizes = [f.stat().st_size for f in files]
    assert len(files) > 10
    keys = store.keys()
    located = store.locate(keys)
    assert located.exceptAll(keys).count() == 0 and located.count() == len(TEXTS)
    back = defaultdict(list)
    for row in store.read(located).collect():
        back[row["_id"]].append((row["copy"], tuple(row["ids"])))
    given = defaultdict(list)
    for i, t in TEXTS:
        given[i].append(tuple(code(t)))
    assert set(back) == set(given)
    for i, found in back.items():
        assert sorted(c for c, _ in found) == list(range(len(given[i])))
        assert Counter(ids for _, ids in found) == Counter(given[i])
    # raw payload: the files' ids in a row are those of ascending documents
    ids = sum(sum(len(x) for x in own) for own in given.values())
    assert sum(sizes) > 2 * ids
    assert store.get(303).tolist() == code(TEXTS[206][1]) and store.get(9999) is None and store.get(7, 4) is None
    assert store.get(None, 1).tolist() == code("null id")


def test_strange_keys_are_told(spark, store):
    asked = spark.createDataFrame([(k, 0) for k in range(5000, 7000)] + [(5, 0), (5, 1)], "_id long, copy long")
    found = store.locate(asked).filter("shard is not null").collect()
    assert [(r["_id"], r["copy"]) for r in found] == [(5, 0)]


def test_minimal_hash_has_no_slot_left_over():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 20_000):
        h1, h2 = rng.integers(-(1 << 63), (1 << 63) - 1, (2, n))
        seeds, slots = token_store.minimal_hash(h1, h2)
        assert sorted(slots.tolist()) == list(range(n))
        assert (token_store.slots_of(h1, h2, seeds) == slots).all()
    with pytest.raises(ValueError):
        token_store.minimal_hash(np.array([4, 4, 1]), np.array([9, 9, 1]))


def test_report(spark, docs, tmp_path):
    code = encoded()
    rows = token_store.report(docs, str(tmp_path / "a"), tokens.path("word_bpe_49k.json"), shard_bytes=20_000).collect()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r[0], r[2], r[3]) for r in rows) == Counter((i, len(code(t)), crc(code(t))) for i, t in TEXTS)
    start = 0
    for row in sorted(rows, key=lambda r: r["start"]):
        assert row["start"] == start
        start += row["n_tokens"]
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    none = token_store.report(docs.limit(0), str(tmp_path / "b"), tokens.path("word_bpe_49k.json"))
    assert none.count() == 0 and none.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_other_vocabularies_take_whole_texts(spark, tmp_path):
    name = tokens.path("byte_bpe_50k.json")
    code = encoded("byte_bpe_50k.json")
    given = spark.createDataFrame([("b", text(3)), ("a", text(4)), ("é", None)], "name string, body string")
    store = token_store.write(given, str(tmp_path / "c"), name, "name", "body")
    assert not token_store.words_apart(json.load(open(name)))
    assert [store.get(k).tolist() for k in ("a", "b", "é")] == [code(text(4)), code(text(3)), [1]]
