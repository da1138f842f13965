"""Each operator against brute force, and on nulls, empty texts, repeats, empty tables and clashing columns."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from palimpsest.llm import (
    decontamination,
    embedding_dedup,
    jaccard_join,
    packing,
    paragraph_dedup,
    pii,
    quality,
    suffix_dedup,
    toxicity,
    url_filters,
)
from palimpsest.session import inline_table

WORDS = "the of and tion ing her that was for with on at by from this are be have not you".split()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, cls long, token string, _k1 long"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[a] + WORDS[b] for a, b in rng.integers(0, len(WORDS), (n, 2)))


BASE = prose(1, 120)
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace(BASE.split()[60], "changed", 1)), (4, prose(2, 90)), (5, None), (6, ""), (7, " \n\t "),
    (8, "one two"), (9, "One TWO"), (None, BASE), (10, prose(3, 20) + " " + BASE[:500] + " " + prose(4, 20)), (11, prose(5, 60_000)),
    (4, prose(2, 90)), (12, "é" * 300 + prose(6, 10)), (13, "é" * 300),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t) if t else 0, 7, "x", 9) for i, t in TEXTS]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def sets(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate({65 + k: 97 + k for k in range(26)}))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_join(docs, none):
    own = [sets(t) for _, t in TEXTS]
    group = list(range(len(TEXTS)))
    for a in range(len(TEXTS)):
        for b in range(a):
            if own[a] and own[b] and 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {g: min((TEXTS[k][0] for k in range(len(TEXTS)) if group[k] == g and TEXTS[k][0] is not None), default=None) for g in group}
    expected = Counter((TEXTS[k][0], len(own[k]), least[group[k]]) for k in range(len(TEXTS)))
    found = jaccard_join.grouped(docs)
    assert rows_of(found.select("_id", "n", "component_id")) == expected
    assert jaccard_join.grouped(none).count() == 0
    kept = [r["doc_id"] for r in jaccard_join.deduplicated(docs).collect()]
    assert sorted(kept) == [1, 4, 5, 6, 7, 8, 10, 11, 12, 13]


def test_jaccard_join_sizes_of_very_common_shingles(spark, monkeypatch):
    words = [f"w{k}" for k in range(137)]
    texts = [" ".join(words[:104]), " ".join(words)]  # 100 shared shingles of 133
    common = np.ones(jaccard_join.COUNTERS, np.int64)
    data = texts[0].encode()
    hot = next(iter(jaccard_join.sets_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))))
    common[(hot & np.uint64(jaccard_join.COUNTERS - 1)).astype(np.int64)] = 200_000
    monkeypatch.setattr(jaccard_join, "counters", lambda rows: common)
    found = jaccard_join.grouped(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert rows_of(found.select("_id", "n", "component_id")) == Counter([(0, 100, 0), (1, 133, 0)])


def test_suffix_dedup(docs, none):
    texts = [(t or "").encode() for _, t in TEXTS]
    seen = Counter(t[k : k + 400] for t in texts if len(t) < 10_000 for k in range(len(t) - 399))
    expected = Counter()
    for (doc, _), data in zip(TEXTS, texts, strict=True):
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 399 if len(data) < 10_000 else 0):
            if seen[data[k : k + 400]] > 1:
                gone[k : k + 400] = True
        left = bytes(c for c, g in zip(data, gone, strict=False) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(data) else 0
        expected[(doc, len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest())] += 1
    found = suffix_dedup.removed(docs).select(
        "doc_id", "n_bytes", F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0]), F.size("runs"), F.sha2("kept", 256)
    )
    assert rows_of(found) == expected
    assert suffix_dedup.removed(none).count() == 0


def test_pii(spark, docs, none):
    text = "ip 10.0.0.1 or 999.1.1.1, mail é a.b@x.example.com and a@b card 4111 1111 1111 1111, +49 (30) 123456-78, IBAN GB82 WEST 1234 5698 7654 32 x"
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def fits(kind, m):
        digits = re.sub(r"\D", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and pii.luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    for sample in [text, text * 3, "x@y.z@w.v.u", "..@a.b", "1.2.3.4.5.6.7.8", "+1+2+3333333333", "0" * 6000 + ".1.1.1", "4" * 40, *(t or "" for _, t in TEXTS)]:
        expected = [(m.start(), m.end(), k) for k, p in plain.items() for m in re.finditer(p, sample) if k != "ip" or len(m[0]) < 4000 if fits(k, m[0])]
        got = [s for s in pii.base_spans(sample) if s[1] - s[0] < 4000]
        assert got == sorted(expected, key=lambda s: (s[0], pii.ORDER[s[2]])), sample[:80]
    assert [k for *_, k, _ in pii.all_spans(text, pii.base_spans(text))].count("iban") == 1
    assert pii.find(docs).count() == len(TEXTS) and pii.find(none).count() == 0
    one = spark.createDataFrame([(1, text, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    masked = pii.redact(one).first()
    assert "<EMAIL>" in masked["text"] and "4111" not in masked["text"] and masked["n_chars"] == len(masked["text"])
    assert [r["text"] for r in pii.redact(docs).filter("doc_id = 5").collect()] == [None]


@pytest.mark.parametrize("block", [decontamination.BLOCK_WORDS, 5])
def test_decontamination(spark, docs, none, block):
    words = BASE.split()
    items = [(1, " ".join(words[30:60])), (2, "ONE two"), (3, None), (None, "..."), (10, " ".join(words[35:47])), (2, prose(9, 30))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = {}
    for item, t in items:
        w = split(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if item is None else str(item))
    expected = Counter()
    for doc, t in TEXTS:
        w = split(t)
        hit, ids = set(), set()
        for win, own in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    ids |= own
        expected[(doc, len(w), len(hit), ",".join(sorted(ids)))] += 1
    found = decontamination.annotate(docs, bench, block_words=block)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    assert rows_of(found.select("doc_id", "n_words", n_hit, F.array_join("items", ","))) == expected
    assert decontamination.annotate(none, bench).count() == 0
    assert decontamination.annotate(docs, bench.limit(0)).filter("size(items) > 0").count() == 0
    cut = {r["doc_id"]: r["text"] for r in decontamination.cut(docs, bench).collect()}
    assert " ".join(words[30:60]) not in cut[1] and cut[11] == TEXTS[11][1] and cut[5] is None


def test_packing(docs, none):
    found = packing.packed(docs, lengths=(256, 1024)).toPandas()
    whole = Counter({k: 0 for k in ()})
    for i, t in TEXTS:
        whole[i] += len((t or "").encode())
    assert found["n_tokens"].sum() == sum(whole.values())
    for _, own in found.groupby(["shard", "bin"]):
        own = own.sort_values("bin_offset")
        assert (own["bin_offset"].to_numpy() == np.concatenate([[0], own["n_tokens"].cumsum()[:-1]])).all()
        used = own["n_tokens"].sum()
        assert set(own["bin_length"]) == {256 if used <= 256 else 1024} and used <= 1024
    assert packing.packed(none).count() == 0


def test_url_filters(spark):
    urls = [None, "", "net/", "http://a.example.NET/en/x?y#z", "https://net/", "ftp://xnet/", "x://b.org/fr/", "http://example.net", "a://b://example.com/de/", "http://example.com/de"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(3, urls[3], "h")], "page_id long, url string, host string")
    rules = inline_table(spark, "host, path, verdict", url_filters.RULES)
    got = rows_of(url_filters.judge(pages, rules))
    con = duckdb.connect()
    frame = pages.toPandas()
    con.register("pages", frame)
    assert got == Counter(con.execute(url_filters.SQL).fetchall())
    assert url_filters.judge(pages.limit(0), rules).count() == 0
    assert url_filters.judge(pages, rules.limit(0)).filter("verdict <> 'allow'").count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16))
    x[200:300] = x[7] + rng.normal(size=(100, 16)) * 0.08
    x[300:320] = x[9]
    vectors = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    vectors += [(400, None), (401, [0.0] * 16), (402, [float("nan")] + [1.0] * 15), (403, [None] + [1.0] * 15), (404, [1.0]), (405, []), (None, vectors[9][1])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<double>, cid long, leaf long")
    got = {r["vec_id"]: tuple(r)[1:] for r in embedding_dedup.near_duplicates(frame, leaf=64).collect()}
    unit = np.vstack([x, x[9:10]]) / np.linalg.norm(np.vstack([x, x[9:10]]), axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    for k in range(400):
        assert got[k][0] == near[k].sum() - 1, k
    assert all(got[k] == (0, k, True) for k in range(400, 406))
    assert got[305][1] == 9 and got[None][1] == 9 and not got[None][2] is None
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_paragraph_dedup(spark, none):
    passage = prose(20, 60)
    near = passage.split()
    near[30] = "changed"
    texts = [prose(21, 40) + "\n" + passage + "\n" + prose(22, 40), passage + "\n" + prose(23, 40), prose(24, 30) + " " + passage + " " + prose(25, 30), " ".join(near), prose(26, 80), None, "", "short line\nshort line"]
    frame = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)], "doc_id long, text string, cls string")
    got = {r["doc_id"]: r for r in paragraph_dedup.removed(frame).collect()}
    assert sum(got[k]["n_removed"] > 0 for k in range(4)) >= 3
    assert all(got[k]["n_removed"] == 0 and got[k]["kept"] == (texts[k] or "") for k in (4, 5, 6, 7))
    assert paragraph_dedup.removed(none).count() == 0
    assert 1 - (1 - 0.75**paragraph_dedup.ROWS) ** paragraph_dedup.BANDS >= paragraph_dedup.RECALL


def test_paragraph_links_among_common_phrases(spark):
    rng = np.random.default_rng(7)
    phrase = prose(30, 16).split()
    lines = []
    for k in range(400):  # unrelated pairs of near copies, all of which hold the common phrase
        own = [f"w{k}x{a}" for a in range(18)]
        near = own.copy()
        near[rng.integers(14, 18)] = f"v{k}"
        lines += [phrase + own, phrase + near]
    frame = spark.createDataFrame([(k, " ".join(line)) for k, line in enumerate(lines)], "doc_id long, text string")
    rows = paragraph_dedup.keyed(frame, "doc_id", "text")
    found = paragraph_dedup.written(paragraph_dedup.paragraphs(rows), "test-places")
    classes = paragraph_dedup.written(paragraph_dedup.classes_of(found), "test-classes")
    tokens = dict(tuple(r) for r in paragraph_dedup._sets(rows, classes.select("cls", "at._k1", "at._k2")).collect())
    own = {c: set(np.frombuffer(t, np.uint64).tolist()) for c, t in tokens.items()}
    names = sorted(own)
    brute = [(a, b) for k, a in enumerate(names) for b in names[:k] if len(own[a] & own[b]) >= 0.75 * len(own[a] | own[b])]
    got = dict(tuple(r) for r in paragraph_dedup.components(paragraph_dedup.linked(rows, classes)).collect())
    at = {r["cls"]: tuple(r["at"]) for r in classes.select("cls", "at").collect()}
    groups = {}  # a line without a cut stands at one place as a line and as a piece
    for c in names:
        groups.setdefault(at[c], set()).add(got.get(c, c))
    brute = [(a, b) for a, b in brute if at[a][:2] != at[b][:2]]
    recall = np.mean([bool(groups[at[a]] & groups[at[b]]) for a, b in brute])
    assert recall >= paragraph_dedup.RECALL, recall


def test_paragraph_dedup_whole_lines_and_passages(spark):
    lines = [prose(40 + k, n) for k, n in enumerate((6, 9, 12, 16, 20, 24, 50))]
    passage = prose(50, 51)
    texts = [prose(60 + k, 7) + "\n" + "\n".join(lines) + "\n" + prose(70 + k, 25) + " " + passage + " " + prose(80 + k, 25) for k in range(3)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r["kept"] for r in paragraph_dedup.removed(frame).collect()]
    assert [sum(line in kept for kept in got) for line in [*lines, passage]] == [1] * 8
    words = [w for kept in got for w in kept.split()]
    assert len(words) <= sum(len(line.split()) for line in lines) + 51 + 3 * 57


def test_classifiers_on_held_out_rows(spark, sf_dir, docs, none):
    big = sf_dir.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    held = toxicity.op9_toxicity(spark, big).filter("held_out").join(labels, "doc_id").toPandas()
    assert (held["predicted"] == held["toxic"]).mean() >= 0.9
    big = sf_dir.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    rated = quality.op7_quality_classifier(spark, big).filter("held_out").join(labels, "doc_id").toPandas()
    assert (rated["kept"] == (rated["quality"] == 1)).mean() >= 0.9
    assert (rated["p_ge_2"] <= rated["p_ge_1"]).all()
    for model in (toxicity.train([], []), toxicity.train([b"bad words", b"good words"], [1, 0])):
        assert toxicity.score(docs, model).filter("score BETWEEN 0 AND 1").count() == len(TEXTS)
        assert toxicity.score(none, model).count() == 0
    model = quality.train([b"a b", b"c d", b"e f"], [0, 1, 2])
    assert quality.rate(docs, model).count() == len(TEXTS) and quality.rate(none, model).count() == 0


@pytest.mark.parametrize("name", ["op1_ngram_jaccard_join", "op2_url_filters"])
def test_sql_twins(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    assert rows_of(entry.queries()[name](spark, sf_dir)) == Counter(con.execute(entry.oracle_sql()[name]).fetchall())


def test_pipeline(spark, sf_dir):
    packed = entry.queries()["pipeline"](spark, sf_dir)
    assert packed.count() > 0 and (packed.filter("bin_used > bin_length").count() == 0)
