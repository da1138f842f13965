"""Best-fit packing into bins of several permitted lengths.

Texts are cut into pieces of at most the largest permitted length and dealt evenly to
shards by a hash.  A shard's pieces go, longest first, into the open bin with the
least room that still holds them; where none does, the bin size with the least cost
per token it can still be filled with is opened; at the end each bin shrinks to the
smallest permitted length that holds its contents.  Only lengths and keys reach the
packer: a shard of fixed size needs fixed memory, whatever the number of texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import keyed, table

#: Tokens are the bytes of the UTF-8 text (a byte-level vocabulary).
LENGTHS = (1024, 2048, 4096, 8192)
#: Cost of a bin of length c: OVERHEAD + c + c * c / QUADRATIC (attention).
OVERHEAD = 64.0
QUADRATIC = 65_536.0
SHARD_PIECES = 20_000


def bin_cost(length: float) -> float:
    return OVERHEAD + length + length * length / QUADRATIC


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece and the final length of each bin; ties keep the input order."""
    lengths = sorted(lengths)
    sizes = np.asarray(sizes, np.int64)
    bins = np.zeros(len(sizes), np.int64)
    offsets = np.zeros(len(sizes), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []  # (free tokens, bin), sorted
    left = int(sizes.sum())
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, home = room.pop(at)
        else:
            fits = [c for c in lengths if c >= size]
            free = min(fits, key=lambda c: (bin_cost(c) / min(c, left), c))
            home = len(used)
            used.append(0)
        bins[k], offsets[k] = home, used[home]
        used[home] += size
        left -= size
        if free > size:
            insort(room, (free - size, home))
    final = np.asarray(lengths, np.int64)[np.searchsorted(lengths, used)] if used else np.zeros(0, np.int64)
    return bins, offsets, final


def packed(
    docs: DataFrame, lengths: Sequence[int] = LENGTHS, id_col: str = "doc_id", text_col: str = "text", with_tokens: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, shard, bin, bin_offset, bin_length, bin_used.

    ``with_tokens`` adds the piece's own tokens (bytes): the pieces of a bin in the order of
    bin_offset are its sequence, and their edges its document boundaries.

    Every token of every text is in exactly one piece.  Null and empty texts have no
    tokens and no rows.  Rows that repeat are packed each for itself; equal lengths
    are taken by key and piece, so a result does not depend on how rows arrive.
    """
    lengths = sorted(lengths)
    top = lengths[-1]
    rows = keyed(docs, id_col, text_col).select("_id", "_k1", "_k2", F.octet_length("_text").cast("long").alias("n")).filter("n > 0")
    cuts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / top).cast("long"))
    pieces = rows.select("_id", "_k1", "_k2", "n", F.explode(cuts).alias("piece")).select(
        "_id", "_k1", "_k2", "piece", F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * top).alias("size")
    )
    count = rows.agg(F.sum(F.floor((F.col("n") - 1) / top) + 1)).first()[0] or 0
    shards = max(1, -(-int(count) // SHARD_PIECES))

    def fill(frame):
        import pandas as pd

        frame = frame.sort_values(["_k1", "_k2", "piece"], kind="stable", ignore_index=True)
        bins, offsets, final = pack(frame["size"].to_numpy(), lengths)
        used = np.bincount(bins, weights=frame["size"].to_numpy(), minlength=len(final)).astype(np.int64)
        return pd.DataFrame(
            {
                "_k1": frame["_k1"], "_k2": frame["_k2"], "doc_id": frame["_id"], "piece": frame["piece"], "start": frame["piece"] * top, "n_tokens": frame["size"],
                "shard": frame["shard"], "bin": bins, "bin_offset": offsets, "bin_length": final[bins], "bin_used": used[bins],
            }
        )

    kind = rows.schema["_id"].dataType.simpleString()
    placed = (
        pieces.withColumn("shard", F.pmod(F.xxhash64("_k1", "_k2", "piece"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(
            fill,
            f"_k1 long, _k2 long, doc_id {kind}, piece long, start long, n_tokens long, shard long, bin long, bin_offset long, bin_length long, bin_used long",
        )
    )
    if not with_tokens:
        return placed.drop("_k1", "_k2")
    # rows equal in id and text share their bytes; placements are narrow, so the texts are shuffled once
    texts = keyed(docs, id_col, text_col).select("_k1", "_k2", "_text").dropDuplicates(["_k1", "_k2"])
    cut = F.expr("substring(cast(_text AS binary), cast(start + 1 AS int), cast(n_tokens AS int))").alias("tokens")
    return placed.join(texts, ["_k1", "_k2"]).select(*[c for c in placed.columns if c not in ("_k1", "_k2")], cut)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
