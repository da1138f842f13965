"""Which files may hold a key: one Bloom filter per file and kind of key, kept beside the tables.

An erasure asks for a few people in many files.  Without help it reads the key of every
row of every file.  The index reads each file once in its life; afterwards the files that
may hold one of the asked keys are known from a few bits per key, and only those are
opened.  A filter never misses a key, so nothing is left behind; a file it names in vain
is opened and found to hold nobody.

Erasing a file takes keys away and adds none, so its filter stays right.  A file that
comes under an old path with another modification time is indexed anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import broadcast_limit, let_workers_import, measured_bytes
from palimpsest.sources import paths

FILE = "_file"
BITS_PER_KEY = 12
PROBES = 7
LEAST_BYTES = 32
FILES_PER_WAVE = 5000
_SCHEMA = "_file string, kind string, stamp timestamp, keys long, broken long, bits binary"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash among so many bits: independent of each other, for small filters too."""
    x = hashes.view(np.uint64)[:, None] + np.arange(1, PROBES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(bits)


def bloom(hashes: np.ndarray) -> bytes:
    """A filter of the hashes, a whole number of bytes."""
    size = max(LEAST_BYTES, -(-len(hashes) * BITS_PER_KEY // 8))
    on = np.zeros(size * 8, np.uint8)
    on[_places(hashes, size * 8).ravel().astype(np.int64)] = 1
    return np.packbits(on, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    words = np.frombuffer(bits, np.uint8)
    at = _places(hashes, len(words) * 8)
    on = (words[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return bool(on.all(axis=1).any())


def waves(frame: DataFrame, size: int = FILES_PER_WAVE) -> Iterator[list[str]]:
    """The first column, a bounded list at a time."""
    wave: list[str] = []
    for row in frame.toLocalIterator():
        wave.append(row[0])
        if len(wave) == size:
            yield wave
            wave = []
    if wave:
        yield wave


@dataclass(frozen=True)
class FileIndex:
    """The index of one folder.

    ``read`` gives the rows of some paths with ``_metadata``; ``keys`` names a key per kind;
    rows for which ``broken`` holds are counted per file, for their keys cannot be read.
    """

    spark: SparkSession
    root: str
    folder: str
    glob: str
    read: Callable[[list[str]], DataFrame]
    keys: Mapping[str, Column]
    broken: Column | None = None

    def stored(self) -> DataFrame:
        paths.make_dirs(self.spark, self.root)
        reader = self.spark.read.schema(_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        return reader.parquet(self.root)

    def files(self) -> DataFrame:
        """``_file, stamp`` of the folder's files, from its listing: no file is opened."""
        paths.make_dirs(self.spark, self.folder)
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", self.glob)
        return reader.load(self.folder).select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias("stamp"))

    def refresh(self) -> int:
        """Index the files that are new; how many there were."""
        new = self.files().join(self.stored().select(FILE, "stamp").distinct(), [FILE, "stamp"], "left_anti")
        count = 0
        for number, wave in enumerate(waves(new.select(FILE))):
            count += len(wave)
            self._filters(wave).write.mode("append").parquet(self.root)
        return count

    def _filters(self, wave: list[str]) -> DataFrame:
        let_workers_import(self.spark)
        rows = self.read([unquote(uri) for uri in wave])
        bad = F.lit(False) if self.broken is None else F.coalesce(self.broken, F.lit(False))
        kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.xxhash64(c).alias("hash"), c.isNotNull().alias("there")) for k, c in self.keys.items()])
        narrow = rows.select(
            F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_modification_time").alias("stamp"), bad.cast("long").alias("bad"), F.explode(kinds).alias("k")
        )
        # one row per file, kind and key before anything is shuffled
        each = narrow.groupBy(FILE, "stamp", "k.kind", F.when(F.col("k.there"), F.col("k.hash")).alias("hash")).agg(F.sum("bad").alias("bad"))

        def made(frame: pd.DataFrame) -> pd.DataFrame:
            held = np.array([int(h) for h in frame["hash"] if h is not None], np.int64)
            first = frame.iloc[0]
            return pd.DataFrame(
                {"_file": [first["_file"]], "kind": [first["kind"]], "stamp": [first["stamp"]], "keys": [len(held)], "broken": [int(frame["bad"].sum())], "bits": [bloom(held)]}
            )

        # hashes beyond 2^53 would not survive pandas' floats beside a null
        exact = each.withColumn("hash", F.col("hash").cast("string")).groupBy(FILE, "stamp", "kind")
        return exact.applyInPandas(made, _SCHEMA)

    def broken_files(self) -> DataFrame:
        """Indexed files with rows whose keys cannot be read."""
        bad = self.stored().where("broken > 0").select(FILE, "stamp").distinct()
        return bad.join(self.files(), [FILE, "stamp"], "left_semi").select(FILE)

    def candidates(self, kind: str, keys: DataFrame) -> DataFrame:
        """``_file``: the files that may hold one of the keys (the first column), each once.

        Files that are not indexed yet may hold any key.  Keys beyond the broadcast limit:
        every file that holds some key of this kind.
        """
        asked = keys.select(F.col(keys.columns[0]).alias("key")).where("key is not null").select(F.xxhash64("key").alias("h")).distinct()
        mine = self.stored().where(F.col("kind") == kind).select(FILE, "stamp", "keys", "bits").dropDuplicates([FILE, "stamp"])
        files = self.files().join(mine, [FILE, "stamp"], "left")
        if measured_bytes(asked) > broadcast_limit(self.spark):
            return files.where("bits is null or keys > 0").select(FILE)
        let_workers_import(self.spark)
        hashes = np.array([row["h"] for row in asked.collect()], np.int64)  # bounded by the broadcast limit
        sent = self.spark.sparkContext.broadcast(hashes)

        def named(batches):
            for batch in batches:
                hold = [bits is None or (len(sent.value) > 0 and may_hold(bits, sent.value)) for bits in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(hold, pa.bool_()))], [FILE])

        return files.select(FILE, "bits").mapInArrow(named, f"{FILE} string")

    def rows(self, files: DataFrame) -> DataFrame:
        """The rows of these files (``_file``); all others stay closed."""
        parts = [self.read([unquote(uri) for uri in wave]) for wave in waves(files.select(FILE))]
        if not parts:
            return self.read([self.folder]).where(F.lit(False))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionAll(part)
        return whole
