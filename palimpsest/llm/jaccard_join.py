"""N-gram Jaccard join with set-relation skipping.

Texts with equal sets of word shingles are one class; classes are joined by prefix
filtering, exactly.

* Shingles are ordered by how common they are (rare first).  The order comes from a
  table of counters over all texts: of fixed size, and any order is right, so a count
  shared by several shingles costs only time.
* Two sets that reach the threshold share a shingle in their prefixes, and at the
  first one they share, enough must be left of both sets.  Lists of a shingle are
  therefore skipped by blocks of set size, and entries by their position.
* Answers are derived from a highly similar set: each list has a pivot, its most
  ordinary set.  Every other set is compared with the pivot first.  Sets linked with
  it are in its component already, so pairs among them are skipped; the rest of a pair
  is compared only if the two distances to the pivot allow it (the Jaccard distance is
  a metric).
* A pair's sets are made and dealt only if its sketches allow a link: parities of the
  shingles' bits, which differ in no more bits than the sets in shingles.  They bound
  the distance of the other pairs from below.

No list is collected: pivots are aggregated before the shuffle, and the joins on a
shingle split a common one's rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import blobs, components, keyed, lean, longs, mix, parities, shingles, slices, small_side, span_hashes, table, word_spans
from palimpsest.session import dropped, written

WIDTH = 5
#: Link when DEN * intersection >= NUM * union.
NUM, DEN = 75, 100
COUNTERS = 1 << 20
SEGMENT = 1 << 16
FAN_IN = 64
#: Above every 1000 * log2(counter + 1), whose counters end at 2^32.
PLAIN = 1 << 16
#: Words of 64 bits in a sketch.
SKETCH = 16
BITS = [f"s{k}" for k in range(SKETCH)]


def sets_of(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first = word_spans(data, offsets)
    return shingles(span_hashes(data, starts, ends), first, WIDTH)


def class_of(u: np.ndarray) -> int:
    return int(mix(np.array([mix(u + np.uint64(11)).sum(dtype=np.uint64) ^ np.uint64(len(u))], np.uint64)).view(np.int64)[0])


# ---------------------------------------------------------------- the order of shingles


def _summed(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(SEGMENT, np.int64)
    for at, n in zip(frame["at"], frame["n"], strict=True):
        total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint32).astype(np.int64)
    at = np.flatnonzero(total)
    n = np.minimum(total[at], (1 << 32) - 1).astype(np.uint32)
    return pd.DataFrame(
        {"segment": [frame["segment"].iloc[0]], "task": [frame["task"].iloc[0]], "at": [at.astype(np.uint16).tobytes()], "n": [n.tobytes()]}
    )


def counters(rows: DataFrame) -> np.ndarray:
    """How often the shingles of each counter occur in all texts."""

    def count(batches):
        total = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for _, _, data, offsets in slices(batch, "_text"):
                for u in sets_of(data, offsets):
                    total[(u & np.uint64(COUNTERS - 1)).astype(np.int64)] += np.uint32(1)
        out: dict[str, list] = {"segment": [], "at": [], "n": []}
        for segment in range(COUNTERS // SEGMENT):
            part = total[segment * SEGMENT : (segment + 1) * SEGMENT]
            at = np.flatnonzero(part)
            if len(at):
                out["segment"].append(segment)
                out["at"].append(at.astype(np.uint16).tobytes())
                out["n"].append(part[at].tobytes())
        yield pa.RecordBatch.from_arrays([longs(out["segment"]), blobs(out["at"]), blobs(out["n"])], ["segment", "at", "n"])

    source = rows.select("_text")
    tasks = source.rdd.getNumPartitions()
    frame = source.mapInArrow(lean(count), "segment long, at binary, n binary").withColumn("task", F.spark_partition_id().cast("long"))
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        frame = frame.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("segment", "task")
        frame = frame.applyInPandas(_summed, "segment long, task long, at binary, n binary")
    total = np.zeros(COUNTERS, np.int64)
    for row in frame.collect():  # one row per segment, COUNTERS numbers in all
        total[row["segment"] * SEGMENT + np.frombuffer(row["at"], np.uint16).astype(np.int64)] += np.frombuffer(row["n"], np.uint32)
    return total


# ---------------------------------------------------------------- prefixes


def prefixes(rows: DataFrame, common: np.ndarray) -> DataFrame:
    """(token, cls, n, pos, plain) of every class's prefix; plain: how ordinary the set is."""
    sent = rows.sparkSession.sparkContext.broadcast(np.minimum(common, (1 << 32) - 1).astype(np.uint32))

    def run(batches):
        common = sent.value
        for batch in batches:
            seen: set[int] = set()
            for _, _, data, offsets in slices(batch, "_text"):
                cls, sizes, plain, tokens, lengths = [], [], [], [], [0]
                for u in sets_of(data, offsets):
                    n = len(u)
                    c = class_of(u)
                    if not n or c in seen:
                        continue
                    seen.add(c)
                    times = common[(u & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    take = n - -(-NUM * n // DEN) + 1
                    cls.append(c)
                    sizes.append(n)
                    plain.append(int(np.log2(times + 1.0).mean() * 1000))
                    tokens.append(u[np.lexsort((u, times))[:take]])
                    lengths.append(lengths[-1] + take)
                flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([longs(cls), longs(sizes), longs(plain), lists], ["cls", "n", "plain", "tokens"])

    got = rows.select("_text").mapInArrow(lean(run), "cls long, n long, plain long, tokens array<long>")
    return got.select("cls", F.expr(f"n * {PLAIN} + plain").alias("np"), F.posexplode("tokens").alias("pos", "token"))


def _enough(n1: str, p1: str, n2: str, p2: str):
    """At the first shared shingle, the rest of both sets can hold the overlap a link needs."""
    return F.expr(
        f"{DEN} * least({n1}, {n2}) >= {NUM} * greatest({n1}, {n2})"
        f" AND {NUM + DEN} * least({n1} - {p1}, {n2} - {p2}) >= {NUM} * ({n1} + {n2})"
    )


def _compared(pairs: DataFrame, rows: DataFrame, light: DataFrame) -> DataFrame:
    """(a, b, near, low, high): whether the pairs' sets link, by exact sizes, and bounds of their distance.

    Only sets of classes that stand in a pair whose sketches allow a link are made and dealt.
    """
    named = written(pairs.selectExpr("a AS cls").union(pairs.selectExpr("b AS cls")).distinct(), "jaccard-named")
    wanted = light.join(small_side(named), "cls").groupBy("cls")
    wanted = wanted.agg(F.min(F.struct("_k1", "_k2", "n", *BITS)).alias("k"), (F.count("*") == 1).alias("single"))
    wanted = written(wanted.select("cls", "k.*", "single"), "jaccard-wanted")
    sides = [wanted.select(F.col("cls").alias(c), *[F.col(name).alias(f"{c}_{name}") for name in ("n", *BITS)]) for c in "ab"]
    rated = pairs.join(sides[0], "a").join(sides[1], "b").selectExpr(
        "a", "b", "a_n + b_n AS n", " + ".join(f"bit_count(a_{name} ^ b_{name})" for name in BITS) + " AS differ"
    )
    rated = written(rated, "jaccard-rated")
    close = f"{NUM + DEN} * differ <= {DEN - NUM} * n"
    alike = rated.filter(close).select("a", "b")
    asked = written(alike.selectExpr("a AS cls").union(alike.selectExpr("b AS cls")).distinct(), "jaccard-asked")
    sets = _sets(rows, wanted.join(small_side(asked), "cls").select("cls", "_k1", "_k2", "single"))
    sides = alike.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b")
    sides = sides.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a").select("a", "b", "ta", "tb")

    def run(batches):
        for batch in batches:
            near, apart = [], []
            for ta, tb in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(ta.as_buffer(), np.uint64), np.frombuffer(tb.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                same = int((x[at] == y).sum())
                total = len(x) + len(y) - same
                near.append(DEN * same >= NUM * total)
                apart.append(1 - same / total)
            apart = pa.array(apart, pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near, pa.bool_()), apart, apart], ["a", "b", "near", "low", "high"])

    found = sides.mapInArrow(lean(run), "a long, b long, near boolean, low double, high double")
    return found.unionAll(rated.filter(f"NOT ({close})").selectExpr("a", "b", "false", "2 * differ / (n + differ)", "1D"))


def links(rows: DataFrame, light: DataFrame) -> DataFrame:
    """(u, v): pairs of classes that reach the threshold, all of them up to skipped pairs of one component."""
    entries = prefixes(rows, counters(rows))
    shared = entries.groupBy("token").agg(F.count("*").alias("times")).filter("times > 1").select("token")
    kept = entries.join(shared, "token").groupBy("token", "cls").agg(F.min("np").alias("np"), F.min("pos").alias("pos"))
    kept = written(kept.selectExpr("token", "cls", f"np div {PLAIN} AS n", f"np % {PLAIN} AS plain", "pos"), "jaccard-lists")

    pivots = kept.groupBy("token").agg(F.max(F.struct("plain", "cls", "n", "pos")).alias("p"), F.count("*").alias("sets")).filter("sets > 1")
    pivots = pivots.select("token", F.col("p.cls").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.pos").alias("pp"))
    listed = written(kept.join(pivots, "token"), "jaccard-listed")
    dropped(kept)
    first = listed.filter("cls <> pivot").filter(_enough("n", "pos", "pn", "pp"))
    first = written(first.select(F.col("cls").alias("a"), F.col("pivot").alias("b")).distinct(), "jaccard-first")
    known = written(_compared(first, rows, light), "jaccard-pivots")

    far = known.withColumnsRenamed({"a": "cls", "b": "pivot"})
    marked = listed.join(small_side(far), ["cls", "pivot"], "left").selectExpr(
        "token", "cls", "n", "pos", "cls = pivot OR coalesce(near, false) AS near",
        "CASE WHEN cls = pivot THEN 0D ELSE coalesce(low, 0D) END AS low", "CASE WHEN cls = pivot THEN 0D ELSE coalesce(high, 1D) END AS high",
        f"cast(floor(ln(n) / ln({DEN} / {NUM})) AS long) AS block",
    )
    marked = written(marked, "jaccard-marked")
    dropped(listed)
    left = marked.filter("NOT near").selectExpr("token", "cls AS a", "n AS n1", "pos AS p1", "low AS l1", "high AS h1", "explode(sequence(block - 1, block + 1)) AS block")
    right = marked.selectExpr("token", "cls AS b", "n AS n2", "pos AS p2", "low AS l2", "high AS h2", "near AS near2", "block")
    # lists are dealt by key at any size, so that what travels grows as they do
    rest = left.join(right.hint("merge"), ["token", "block"]).filter("a <> b AND (near2 OR a < b)").filter(_enough("n1", "p1", "n2", "p2"))
    rest = rest.filter(f"greatest(l1 - h2, l2 - h1) <= 1 - {NUM} / {DEN} + 1e-9").select("a", "b").distinct()
    rest = rest.join(known.select("a", "b"), ["a", "b"], "left_anti").join(known.selectExpr("b AS a", "a AS b"), ["a", "b"], "left_anti")
    found = known.unionAll(_compared(written(rest, "jaccard-rest"), rows, light))
    return found.filter("near").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, tokens): the sorted shingles of one text of each wanted class (cls, _k1, _k2, single).

    A text that is single in its class stands in one row; only the others may come twice.
    """
    texts = rows.join(small_side(wanted.select("_k1", "_k2", "single")), ["_k1", "_k2"]).select("_text", "single")

    def run(batches):
        for batch in batches:
            for row, n, data, offsets in slices(batch, "_text"):
                got = list(sets_of(data, offsets))
                columns = [longs([class_of(u) for u in got]), blobs([u.tobytes() for u in got]), batch.column(1).slice(row, n)]
                yield pa.RecordBatch.from_arrays(columns, ["cls", "tokens", "single"])

    made = written(texts.mapInArrow(lean(run), "cls long, tokens binary, single boolean"), "jaccard-sets")
    once = written(made.filter("NOT single").select("cls", "tokens").dropDuplicates(["cls"]), "jaccard-once")
    return made.filter("single").select("cls", "tokens").unionAll(once)


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    return parities(np.concatenate(sets), np.array([len(u) for u in sets]), SKETCH)


def classes(rows: DataFrame) -> DataFrame:
    """(_id, _k1, _k2, n, cls, words of the sketch) of every row; cls is null where the set is empty."""
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, rows_here, data, offsets in slices(batch, "_text"):
                sets = list(sets_of(data, offsets))
                cls = pa.array([class_of(u) if len(u) else None for u in sets], pa.int64())
                own = [column.slice(row, rows_here) for column in batch.columns[:3]]
                columns = [*own, longs([len(u) for u in sets]), cls, *map(longs, _sketches(sets).T)]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_k1", "_k2", "n", "cls", *BITS])

    return rows.mapInArrow(lean(run), f"_id {kind}, _k1 long, _k2 long, n long, cls long, {', '.join(f'{name} long' for name in BITS)}")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: _id, _k1, _k2, n, component_id, kept.

    Rows are nodes: copies and repeated rows are linked with each other.  Null texts and
    texts without words have n = 0 and stay alone (component_id is their own id).  The
    component's id is the smallest id in it that is not null; kept marks the row with
    that id (of rows that repeat an id, the one with the smallest text hash; rows equal
    in both are all marked).  Other columns are not read.
    """
    rows = keyed(docs, id_col, text_col)
    light = written(classes(rows), "jaccard-classes")
    joined = components(links(rows, light.filter("cls IS NOT NULL").drop("_id")), "jaccard-components")
    whole = light.drop(*BITS).join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_k1", "_k2")
    tops = whole.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("top"))
    whole = whole.join(tops, "component", "left")
    return whole.select(
        "_id", "_k1", "_k2", "n",
        F.when(F.col("component").isNull(), F.col("_id")).otherwise(F.col("top._id")).alias("component_id"),
        (F.col("component").isNull() | ((F.col("_k1") == F.col("top._k1")) & (F.col("_k2") == F.col("top._k2")))).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """documents with one row of each component; rows that repeat entirely count as one."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    gone = grouped(docs).filter("NOT kept").select("_k1", "_k2")
    rows = docs.select(*names, F.xxhash64("doc_id").alias("_k1"), F.xxhash64("text").alias("_k2"))
    again = rows.groupBy("_k1", "_k2").count().filter("count > 1").select("_k1", "_k2")
    again = small_side(written(again, "jaccard-again"))
    rows = rows.join(small_side(written(gone.distinct(), "jaccard-gone")), ["_k1", "_k2"], "left_anti")
    once = rows.join(again, ["_k1", "_k2"], "left_anti")
    twice = rows.join(again, ["_k1", "_k2"], "left_semi").dropDuplicates(["_k1", "_k2"])
    return once.unionAll(twice).select(*names)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grouped(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


#: Equal texts are compared once; their sets are joined on shared shingles.
SQL = """
WITH cleaned AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM cleaned
), docs AS (
  SELECT doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS k, s FROM sets
), cls AS (
  SELECT k, min(doc_id) AS id, any_value(n) AS n, any_value(s) AS s FROM docs WHERE n > 0 GROUP BY k
), grams AS (
  SELECT id, n, unnest(s) AS g FROM cls
), pairs AS (
  SELECT a.id AS x, b.id AS y
  FROM grams a JOIN grams b ON a.g = b.g AND a.id < b.id AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), linked AS (
  SELECT x, y FROM pairs UNION SELECT y, x FROM pairs
), reach AS (
  WITH RECURSIVE r(x, y) AS (SELECT id, id FROM cls UNION SELECT r.x, b.y FROM r JOIN linked b ON r.y = b.x) SELECT x, min(y) AS c FROM r GROUP BY x
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, CASE WHEN d.n = 0 THEN d.doc_id ELSE r.c END AS component_id
FROM docs d LEFT JOIN cls USING (k) LEFT JOIN reach r ON r.x = cls.id
"""
