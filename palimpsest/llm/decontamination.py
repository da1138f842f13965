"""Benchmark decontamination by an FM-index per shard of training documents.

The test phrases are all windows of ten words of the benchmark items.  Their words are
the index's alphabet: a document word outside it can be in no occurrence, so a run of
such words is one separator, and a run of phrase words shorter than the shortest
phrase is left out as well.  That is exact, and small: each task builds the index of a
shard from whole documents, searches every phrase backwards through the wavelet
matrix, locates the occurrences by sampled suffix positions and merges their spans.

The benchmark is a query set of any size: it reaches the tasks in blocks of bounded
size, one pass over the documents each.  Documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from palimpsest.llm.common import NOT_ALNUM, longs, slices, span_hashes, table, word_spans
from palimpsest.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_WORDS = 300_000
#: A shard's index is built when it holds so many symbols, or so many bytes of text wait for it.
SHARD_SYMBOLS = 1_000_000
SHARD_BYTES = 64_000_000


class Block:
    """Windows of some benchmark items: alphabet, phrases as symbols, and whose they are."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        hashed: list[np.ndarray] = []
        owners: list[int] = []
        self.items = [item for item, _ in items]
        for k, (_, text) in enumerate(items):
            data = np.frombuffer((text or "").encode(), np.uint8)
            starts, ends, _ = word_spans(data, np.array([0, len(data)]), NOT_ALNUM)
            words = span_hashes(data, starts, ends)
            n = len(words)
            for at in range(max(1, n - window + 1) if n else 0):
                hashed.append(words[at : at + window])
                owners.append(k)
        self.alphabet = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, np.uint64)
        rows = np.zeros((len(hashed), window), np.int32)
        for k, words in enumerate(hashed):
            rows[k, window - len(words) :] = np.searchsorted(self.alphabet, words) + 1
        self.phrases, of = np.unique(rows, axis=0, return_inverse=True) if hashed else (rows, np.zeros(0, np.int64))
        self.lengths = (self.phrases > 0).sum(axis=1)
        owned = np.unique(np.stack([of.ravel(), np.asarray(owners, np.int64)], axis=1), axis=0) if hashed else np.zeros((0, 2), np.int64)
        self.owner_items = owned[:, 1]
        self.owner_first = np.searchsorted(owned[:, 0], np.arange(len(self.phrases) + 1))
        self.shortest = int(self.lengths.min()) if hashed else 1 << 30


class Shard:
    """Whole documents gathered until their index is built and searched."""

    def __init__(self, block: Block):
        self.block = block
        self.reset()

    def reset(self) -> None:
        self.batches: list[pa.RecordBatch] = []
        self.n_words: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs = self.symbols = self.bytes = 0

    def add(self, batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        starts, ends, first = word_spans(data, offsets, NOT_ALNUM)
        self.batches.append(batch)
        self.n_words.append(np.diff(first))
        alphabet = self.block.alphabet
        if len(alphabet) and len(starts):
            words = span_hashes(data, starts, ends)
            at = np.minimum(np.searchsorted(alphabet, words), len(alphabet) - 1)
            known = alphabet[at] == words
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            new = np.ones(len(words), bool)
            new[1:] = (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])
            run = np.cumsum(new) - 1
            keep = known & (np.bincount(run)[run] >= self.block.shortest)
            if keep.any():
                base = offsets[doc[keep]]
                index = np.arange(len(words)) - first[doc]
                self.parts.append((at[keep] + 1, run[keep], doc[keep] + self.docs, index[keep], starts[keep] - base, ends[keep] - base))
                self.symbols += int(keep.sum())
        self.docs += batch.num_rows
        self.bytes += len(data)

    @property
    def full(self) -> bool:
        return self.symbols >= SHARD_SYMBOLS or self.bytes >= SHARD_BYTES

    def flush(self) -> pa.RecordBatch:
        spans: list[list] = [[] for _ in range(self.docs)]
        items: list[list] = [[] for _ in range(self.docs)]
        if self.parts:
            self._search(spans, items)
        kept = pa.Table.from_batches(self.batches).combine_chunks()
        n_words = longs(np.concatenate(self.n_words))
        out = pa.RecordBatch.from_arrays(
            [*(_one(c) for c in kept.columns), n_words, pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
            [*kept.column_names, "n_words", "spans", "items"],
        )
        self.reset()
        return out

    def _search(self, spans: list[list], items: list[list]) -> None:
        block = self.block
        runs = [p[1] for p in self.parts]
        shift = np.cumsum([0] + [int(r[-1]) + 1 for r in runs])
        run = np.concatenate([r + s for r, s in zip(runs, shift, strict=False)])
        symbol, doc, index, start, end = (np.concatenate([p[k] for p in self.parts]) for k in (0, 2, 3, 4, 5))
        # one separator before each run
        new = np.ones(len(run), bool)
        new[1:] = run[1:] != run[:-1]
        at = np.arange(len(run)) + np.cumsum(new)
        text = np.zeros(at[-1] + 2, np.int64)
        text[at] = symbol
        source = np.full(len(text), -1, np.int64)
        source[at] = np.arange(len(run))
        fm = FMIndex(text, len(block.alphabet))
        low, high = fm.search(block.phrases, block.lengths)
        times = np.maximum(high - low, 0)
        if not times.sum():
            return
        phrase = np.repeat(np.arange(len(times)), times)
        rows = np.repeat(low, times) + np.arange(len(phrase)) - np.repeat(np.cumsum(times) - times, times)
        place = fm.locate(rows)
        cover = np.zeros(len(text) + 1, np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + block.lengths[phrase], -1)
        hit = source[np.flatnonzero(np.cumsum(cover[:-1]) > 0)]
        hit = hit[hit >= 0]
        begins = np.ones(len(hit), bool)
        begins[1:] = (doc[hit[1:]] != doc[hit[:-1]]) | (index[hit[1:]] != index[hit[:-1]] + 1)
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(hit)) - 1
        for a, b in zip(hit[first].tolist(), hit[last].tolist(), strict=True):
            spans[doc[a]].append([int(index[a]), int(index[b]) + 1, int(start[a]), int(end[b])])
        pairs = np.unique(np.stack([doc[source[place]], phrase], axis=1), axis=0)
        for d, p in pairs.tolist():
            items[d].extend(block.owner_items[block.owner_first[p] : block.owner_first[p + 1]].tolist())
        for d in np.unique(pairs[:, 0]).tolist():
            items[d] = sorted({block.items[k] for k in items[d]})


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def blocks(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark read through the driver, one bounded block at a time."""
    held: list[tuple[str, str]] = []
    words = 0
    named = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_col)
    for item, text in named.toLocalIterator():
        held.append((item, text))
        words += len(text or "") // 6 + 1
        if words >= block_words:
            yield Block(held, window)
            held, words = [], 0
    if held:
        yield Block(held, window)


def annotate(
    docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = ("doc_id",), window: int = WINDOW,
    block_words: int = BLOCK_WORDS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """carry columns + n_words, spans, items for every row of docs.

    spans are merged hit runs [first word, end word, first byte, end byte); items are
    the ids (as strings, sorted) of the items with a window in the text.  Null and
    empty texts have no words; items without words have no windows; a null item id
    counts as the empty string; with no items nothing is hit.  Repeated rows are rows
    of their own; columns not in carry are not read.
    """
    spark = docs.sparkSession
    carried = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)], *_keys(docs, id_col, text_col))
    out = StructType(
        [*[StructField(f.name, f.dataType) for f in carried.schema if f.name != "_text"], StructField("n_words", LongType()),
         StructField("spans", ArrayType(ArrayType(LongType()))), StructField("items", ArrayType(StringType()))]
    )
    passes = []
    for block in _or_empty(blocks(benchmark, window, block_words, item_col, item_text), window):
        sent = spark.sparkContext.broadcast(block)
        passes.append(carried.mapInArrow(_runner(sent), out))
    frame = passes[0]
    if len(passes) > 1:
        more = passes[1].select("_k1", "_k2", "spans", "items")
        for other in passes[2:]:
            more = more.unionAll(other.select("_k1", "_k2", "spans", "items"))
        more = more.filter("size(items) > 0").groupBy("_k1", "_k2").agg(
            F.flatten(F.collect_set("spans")).alias("spans2"), F.flatten(F.collect_set("items")).alias("items2")
        )
        frame = frame.join(more, ["_k1", "_k2"], "left")
        frame = frame.withColumn("items", F.array_sort(F.array_distinct(F.concat("items", F.coalesce("items2", F.array().cast("array<string>"))))))
        frame = frame.withColumn("spans", _merged(F.concat("spans", F.coalesce("spans2", F.array().cast("array<array<bigint>>")))))
    return frame.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], "n_words", "spans", "items")


def _keys(docs: DataFrame, id_col: str, text_col: str) -> list:
    return [
        F.xxhash64(F.col(id_col)).alias("_k1"), F.xxhash64(F.col(text_col)).alias("_k2"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ]


def _or_empty(found: Iterator[Block], window: int) -> Iterator[Block]:
    some = False
    for block in found:
        some = True
        yield block
    if not some:
        yield Block([], window)


def _runner(sent):
    def run(batches):
        shard = Shard(sent.value)
        for batch in batches:
            for row, n, data, offsets in slices(batch, "_text"):
                shard.add(batch.slice(row, n).drop_columns(["_text"]), data, offsets)
                if shard.full:
                    yield shard.flush()
        if shard.docs:
            yield shard.flush()

    return run


def _merged(spans):
    """Spans of several passes as maximal runs of words."""
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast("array<array<bigint>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(F.element_at(done, -1), 2) >= x[0]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.array(
                        F.element_at(done, -1)[0], F.greatest(F.element_at(done, -1)[1], x[1]),
                        F.element_at(done, -1)[2], F.greatest(F.element_at(done, -1)[3], x[3]),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )


def cut(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents without the hit runs of words; texts without a hit stay byte for byte."""
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    found = annotate(docs, benchmark, carry=tuple(names))

    def run(batches):
        for batch in batches:
            texts, sizes = [], []
            for text, size, spans in zip(*(batch.column(k).to_pylist() for k in (1, 4, 6)), strict=True):
                if spans:
                    data = text.encode()
                    edges = [0, *[b for s in spans for b in s[2:]], len(data)]
                    text = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode()
                    size = len(text)
                texts.append(text)
                sizes.append(size)
            cols = [batch.column(0), pa.array(texts, pa.string()), batch.column(2), batch.column(3), pa.array(sizes, batch.schema.field(4).type)]
            yield pa.RecordBatch.from_arrays(cols, names)

    return found.mapInArrow(run, docs.select(*names).schema)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annotate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
