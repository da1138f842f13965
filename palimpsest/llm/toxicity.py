"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is the average of the embeddings of its subwords (the word and its n-grams of 3
to 5 bytes, with a mark at either end, hashed into buckets), a window the average of
its words, and a softmax over a window's vector gives its class.  A text scores as its
second most toxic window, so a long text is judged like a short one.  Embeddings and softmax
are trained together on a bounded sample of labelled rows; a misspelling never seen
shares n-grams with words that were.

Scoring is a map over whole texts: embeddings times softmax weights is one number per
bucket, sent to the tasks (a fixed size, whatever the data).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import LOWERED, NOT_ALNUM, lean, mix, powers, sampled, slices, small_side, span_hashes, table, trained, word_spans
from palimpsest.session import written


BUCKETS = 1 << 17
DIM = 8
GRAMS = (3, 4, 5)
WINDOW_WORDS = 1
HOP = 1
#: At most so many labelled rows of each label, none longer than so many bytes, are learned from.
SAMPLE_ROWS = {0: 2500, 1: 1000}
SAMPLE_BYTES = 8_000
EPOCHS = 30
RATE = 0.3
THRESHOLD = 0.3
_GRAM = np.uint64(0x100000001B3)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same texts with a space before, between and after them."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    lengths = np.diff(offsets)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), lengths)] = data
    return out, offsets + np.arange(1, n + 2)


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """Per n: (bucket at each byte, first gram, end gram of each word); and each word's own bucket.

    data has a byte on either side of every word; breaks all look alike to the grams.
    """
    values = LOWERED.copy()
    values[NOT_ALNUM] = LOWERED[32]
    code = values[data]
    grams = []
    n = len(data)
    for width in GRAMS:
        rolled = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width if len(rolled) else 0):
            rolled = rolled * _GRAM + code[k : n - width + 1 + k]
        bucket = (mix(rolled + np.uint64(width)) & np.uint64(BUCKETS - 1)).astype(np.int32)
        first = starts - 1
        grams.append((bucket, first, np.maximum(first, ends + 2 - width)))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(code * powers(n, 0x9E3779B97F4A7C15 | 1, "up"), out=sums[1:])
    own = (sums[ends] - sums[starts]) * powers(n + 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64), "down")[starts]
    return grams, (mix(own) & np.uint64(BUCKETS - 1)).astype(np.int32)


def word_scores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, weight: np.ndarray) -> np.ndarray:
    grams, own = subwords(data, starts, ends)
    total = weight[own].astype(np.float64)
    count = np.ones(len(starts))
    for bucket, first, end in grams:
        sums = np.zeros(len(bucket) + 1)
        np.cumsum(weight[bucket], out=sums[1:])
        total += sums[np.minimum(end, len(bucket))] - sums[np.minimum(first, len(bucket))]
        count += end - first
    return total / count


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end word of every window, and the first window of each text (texts without words have none)."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(0, -(-(n - WINDOW_WORDS) // HOP)) + 1, 0)
    where = np.concatenate([[0], np.cumsum(count)])
    of = np.repeat(np.arange(len(n)), count)
    start = first[of] + (np.arange(where[-1]) - where[of]) * HOP
    return start, np.minimum(start + WINDOW_WORDS, first[of + 1]), where


def text_logits(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray, bias: float) -> np.ndarray:
    wide, offs = spaced(data, offsets)
    starts, ends, first = word_spans(wide, offs, NOT_ALNUM)
    out = np.full(len(offsets) - 1, bias)
    if len(starts):
        sums = np.concatenate([[0.0], np.cumsum(word_scores(wide, starts, ends, weight))])
        start, end, where = windows(first)
        each = (sums[end] - sums[start]) / (end - start) + bias
        some = where[1:] > where[:-1]
        first_window = where[:-1][some]
        top = np.maximum.reduceat(each, first_window)
        # the second most toxic window, where there are two: one odd word alone does not make a text toxic
        of = np.repeat(np.arange(len(top)), np.diff(where)[some])
        best = np.flatnonzero(each == top[of])
        best = best[np.unique(of[best], return_index=True)[1]]
        rest = each.copy()
        rest[best] = -np.inf
        second = np.maximum.reduceat(rest, first_window)
        out[some] = np.where(np.isfinite(second), second, top)
    return out


def vocabulary(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number at each place, first place of each text, and the distinct words with spaces around them."""
    names, counts, spelled = [], [], {}
    for text in texts:
        data = np.frombuffer(text, np.uint8)
        starts, ends, _ = word_spans(data, np.array([0, len(data)]), NOT_ALNUM)
        name = span_hashes(data, starts, ends)
        names.append(name)
        counts.append(len(name))
        for k, a, b in zip(name.tolist(), starts.tolist(), ends.tolist(), strict=True):
            if k not in spelled:
                spelled[k] = text[a:b]
    distinct, word = np.unique(np.concatenate(names), return_inverse=True)
    wide = b" " + b" ".join(spelled[k] for k in distinct.tolist()) + b" "
    return word.astype(np.int32), np.concatenate([[0], np.cumsum(counts)]), np.frombuffer(wide, np.uint8)


def train(texts: list[bytes], labels: list[int], seed: int = 7) -> tuple[np.ndarray, float]:
    """(score per bucket, bias): the toxic minus the clean logit of the trained model."""
    y = np.asarray(labels, np.float64)
    rng = np.random.default_rng(seed)
    table_ = rng.normal(0, 0.3, (BUCKETS, DIM))
    head = np.zeros((2, DIM))
    bias = np.zeros(2)
    if not len(y) or y.min() == y.max():
        return np.zeros(BUCKETS, np.float32), float(-4.0 if not y.sum() else 4.0)
    word, first, wide = vocabulary(texts)
    starts, ends, _ = word_spans(wide, np.array([0, len(wide)]), NOT_ALNUM)
    grams, own = subwords(wide, starts, ends)
    # gram lists of the distinct words, one after the other
    per_word = 1 + sum(b - a for _, a, b in grams)
    at = np.concatenate([[0], np.cumsum(per_word)])
    bucket = np.zeros(at[-1], np.int32)
    bucket[at[:-1]] = own
    put = at[:-1] + 1
    for code, a, b in grams:
        n = b - a
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        bucket[np.repeat(put, n) + within] = code[np.repeat(a, n) + within]
        put = put + n
    chunks = [(k, min(k + 20_000, len(own))) for k in range(0, len(own), 20_000)]
    start, end, where = windows(first)
    some = where[1:] > where[:-1]
    keep = np.flatnonzero(some)
    moments = [np.zeros_like(v) for v in (table_, head, bias)], [np.zeros_like(v) for v in (table_, head, bias)]
    target = y[keep]
    slot = np.repeat((np.cumsum(some) - 1).astype(np.int32), np.diff(where))
    first_window = where[:-1][some]
    balance = np.where(y[keep] > 0, 0.5 / y[keep].mean(), 0.5 / (1 - y[keep]).mean())
    for epoch in range(1, EPOCHS + 1):
        # two classes: the softmax needs the difference of the logits only
        weight = table_ @ (head[1] - head[0])
        each = np.concatenate([np.add.reduceat(weight[bucket[at[a] : at[b]]], at[a:b] - at[a]) for a, b in chunks])
        each = (each / per_word)[word]
        total = np.concatenate([[0.0], np.cumsum(each)])
        lead = (total[end] - total[start]) / (end - start) + bias[1] - bias[0]
        # windows share a text's error by a softmax: alike at first, the most toxic ones in the end
        top = np.maximum.reduceat(lead, first_window)
        share = np.exp(lead - top[slot])
        share /= np.add.reduceat(share, first_window)[slot]
        pooled = np.add.reduceat(share * lead, first_window)
        wrong = (1 / (1 + np.exp(-np.clip(pooled, -500, 500))) - target) * balance / len(keep)
        pick = np.flatnonzero(share > 1e-4)
        error = wrong[slot[pick]] * share[pick]
        # back to words, then to buckets
        scaled = error / (end - start)[pick]
        back = np.bincount(start[pick], scaled, len(each) + 1) - np.bincount(end[pick], scaled, len(each) + 1)
        coef = np.bincount(word, np.cumsum(back[:-1]), len(own)) / per_word
        per_bucket = np.zeros(BUCKETS)
        for a, b in chunks:
            per_bucket += np.bincount(bucket[at[a] : at[b]], np.repeat(coef[a:b], per_word[a:b]), BUCKETS)
        coef = per_bucket
        coef = np.stack([-coef, coef], axis=1)
        error = np.stack([-error, error], axis=1)
        slopes = coef @ head, coef.T @ table_, error.sum(axis=0)
        for v, g, m1, m2, rate in zip((table_, head, bias), slopes, *moments, (RATE, RATE, RATE), strict=True):
            m1 += 0.1 * (g - m1)
            m2 += 0.01 * (g * g - m2)
            v -= rate * (m1 / (1 - 0.9**epoch)) / (np.sqrt(m2 / (1 - 0.99**epoch)) + 1e-8)
    return (table_ @ (head[1] - head[0])).astype(np.float32), float(bias[1] - bias[0])


def learned_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> pa.Table:
    """Labelled rows outside the held-out fold: (_text, y), a bounded sample of each class."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4))
    named = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold != 2)).groupBy("doc_id").agg(F.max(label).alias("y"))
    named = written(named.withColumn("_o", F.xxhash64("doc_id", F.lit(17))), "toxic-labels")
    texts = docs.select("doc_id", F.col("text").alias("_text")).filter(F.octet_length("_text") <= SAMPLE_BYTES)
    return sampled(named, lambda keys: texts.join(small_side(keys), "doc_id"), SAMPLE_ROWS)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    weight, bias = trained(learned_rows(docs, labels), train)
    return weight.astype(np.float32), float(bias[0])


def score(docs: DataFrame, model: tuple[np.ndarray, float], carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry columns + score (0 to 1) for every row of docs, from its whole text and nothing else.

    Null and empty texts, and texts without words, get the score of the bias.  Repeated
    rows are rows of their own and score alike; columns not in carry are not read.
    """
    source = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)], F.coalesce("text", F.lit("")).alias("_text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    out = source.drop("_text").withColumn("score", F.lit(0.0)).schema

    def run(batches):
        weight, bias = sent.value
        for batch in batches:
            scores = []
            for _, _, data, offsets in slices(batch, "_text"):
                scores.append(1 / (1 + np.exp(-np.clip(text_logits(data, offsets, weight, bias), -500, 500))))
            got = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got)], [*batch.schema.names[:-1], "score"])

    return source.mapInArrow(lean(run), out).select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
