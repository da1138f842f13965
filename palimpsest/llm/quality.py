"""Quality: ordinal cumulative-link regression on graded ratings.

P(grade >= k) = sigmoid(w . x - t_k): one weight vector over hashed text features for
all grades, and thresholds t_1 < t_2 < ... kept in order by learning their gaps.  The
features are words, word shapes (letters, digits, marks) and word pairs of the whole
text.  The expected grade ranks texts; the tail probability of a grade selects them.

Fitted in numpy on a bounded sample of labelled rows, applied as a map over whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import STEP, map_arrow, mix, slices, sampled, small_side, span_hashes, table, trained, word_spans

from palimpsest.session import written

BUCKETS = 1 << 18
#: At most so many labelled rows of each grade, none longer than so many bytes, are learned from.
SAMPLE_PER_GRADE = 1500
SAMPLE_BYTES = 32_000
EPOCHS = 80
RATE = 0.05
RIDGE = 1e-5
#: A text is selected if P(grade >= SELECT_GRADE) reaches SELECT_AT.
SELECT_GRADE = 1
SELECT_AT = 0.5

_SHAPES = np.zeros(256, np.uint8)
_SHAPES[:] = 3
_SHAPES[48:58] = 2
_SHAPES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def grade_of(quality: Column, toxic: Column) -> Column:
    """The graded rating of a labelled row: 0 poor, 1 good but toxic, 2 good and clean."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value): every text's vector has length 1, or no entry if it has no words."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    shape = _SHAPES[data]
    seen = np.zeros((len(data) + 1, 4), np.int32)
    for k in (1, 2, 3):
        np.cumsum(shape == k, out=seen[1:, k])
    count = np.minimum(seen[ends] - seen[starts], 3)
    form = mix((count[:, 1] + 4 * count[:, 2] + 16 * count[:, 3]).astype(np.uint64) + np.uint64(1 << 40))
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    pairs = mix(words[:-1] * STEP[0] + words[1:] * STEP[1])
    same = of[:-1] == of[1:]
    repeat = words[:-1] == words[1:]
    twice = np.full(int((same & repeat).sum()), mix(np.array([7], np.uint64))[0])
    code = np.concatenate([words, form, pairs[same], twice])
    text = np.concatenate([of, of, of[:-1][same], of[:-1][same & repeat]])
    key = text * BUCKETS + (code & np.uint64(BUCKETS - 1)).astype(np.int64)
    key, n = np.unique(key, return_counts=True)
    text, bucket, value = key // BUCKETS, key % BUCKETS, np.sqrt(n)
    norm = np.sqrt(np.bincount(text, value * value, len(first) - 1))
    return text, bucket, value / norm[text]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[bytes], grades: list[int], n_grades: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds); thresholds are increasing."""
    weight = np.zeros(BUCKETS)
    gaps = np.array([-1.0] + [0.5] * (n_grades - 2))
    if not texts:
        return weight, np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
    parts = []
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in some])]).astype(np.int64)
        text, bucket, value = features(np.frombuffer(b"".join(some), np.uint8), offsets)
        parts.append((text + at, bucket, value))
    text, bucket, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    y = np.asarray(grades)
    m = np.zeros(BUCKETS), np.zeros(len(gaps))
    v = np.zeros(BUCKETS), np.zeros(len(gaps))
    for epoch in range(1, EPOCHS + 1):
        cuts = np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])
        score = np.bincount(text, weight[bucket] * value, len(y))
        tail = np.concatenate([np.ones((len(y), 1)), sigmoid(score[:, None] - cuts), np.zeros((len(y), 1))], axis=1)
        slope = tail * (1 - tail)
        rows = np.arange(len(y))
        p = np.maximum(tail[rows, y] - tail[rows, y + 1], 1e-9)
        d_score = -(slope[rows, y] - slope[rows, y + 1]) / p / len(y)
        d_cut = np.zeros(n_grades + 1)
        np.add.at(d_cut, y, slope[rows, y] / p / len(y))
        np.add.at(d_cut, y + 1, -slope[rows, y + 1] / p / len(y))
        d_cut = d_cut[1:-1]
        d_gap = np.concatenate([[d_cut.sum()], np.cumsum(d_cut[::-1])[::-1][1:] * np.exp(gaps[1:])])
        slopes = np.bincount(bucket, d_score[text] * value, BUCKETS) + RIDGE * weight, d_gap
        for x, g, m1, m2 in zip((weight, gaps), slopes, m, v, strict=True):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            x -= RATE * (m1 / (1 - 0.9**epoch)) / (np.sqrt(m2 / (1 - 0.99**epoch)) + 1e-7)
    return weight.astype(np.float32), np.concatenate([gaps[:1], gaps[0] + np.cumsum(np.exp(gaps[1:]))])


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Learn from labelled rows outside the held-out fold; rows with a null id or label are not used."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    named = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(fold != 2)
    named = named.groupBy("doc_id").agg(F.max(grade_of(F.col("quality"), F.coalesce("toxic", F.lit(0)))).alias("y"))
    named = written(named.withColumn("_o", F.xxhash64("doc_id", F.lit(23))), "quality-labels")
    texts = docs.select("doc_id", F.col("text").alias("_text")).filter(F.octet_length("_text") <= SAMPLE_BYTES)
    rows = sampled(named, lambda keys: texts.join(small_side(keys), "doc_id"), dict.fromkeys((0, 1, 2), SAMPLE_PER_GRADE))
    weight, cuts = trained(rows, train)
    return weight.astype(np.float32), cuts


def rate(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, expected_grade, p_ge_1, p_ge_2, ... for every row, from its whole text only.

    Null, empty and wordless texts have an empty vector: the thresholds alone decide.
    Repeated rows are rows of their own and rate alike; other columns are not read.
    """
    source = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    tails = [f"p_ge_{k + 1}" for k in range(len(model[1]))]

    def run(batch: pa.RecordBatch):
        weight, cuts = sent.value
        scores = []
        for _, n, data, offsets in slices(batch, "_text"):
            text, bucket, value = features(data, offsets)
            scores.append(np.bincount(text, weight[bucket] * value, n))
        score = np.concatenate(scores) if scores else np.zeros(0)
        tail = sigmoid(score[:, None] - cuts)
        cols = [pa.array(tail.sum(axis=1)), *[pa.array(np.ascontiguousarray(tail[:, k])) for k in range(len(cuts))]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "expected_grade", *tails])

    kind = source.schema["_id"].dataType.simpleString()
    return map_arrow(source, run, ", ".join([f"doc_id {kind}", "expected_grade double", *[f"{t} double" for t in tails]]))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rated = rate(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return rated.withColumn("held_out", F.coalesce(held_out, F.lit(False))).withColumn(
        "kept", F.col(f"p_ge_{SELECT_GRADE}") >= SELECT_AT
    )
