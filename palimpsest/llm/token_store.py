"""Token ids of documents as raw binary shards, with a minimal perfect hash index over them.

Shards.  Documents are dealt by ranges of their id to shards of bounded size and sorted;
the task of a shard encodes its texts and writes them as one file.  Spark's own text
writer writes it: a value's bytes go out as they are, and the line separator is the end
id's bytes, so the file is the ids of one document after the other, each 2 bytes (4 if
the vocabulary needs it), little-endian, each document closed by the end id.  Writes go
through Spark's file system and commit protocol: a lost or doubled task leaves no file.
The last value of a shard is its footer: ids and lengths of its documents.

Index.  A document's key is its id and the number of its copy (0 where ids do not repeat).
Keys are dealt to parts of bounded size by a hash; in each part a displacement per bucket
sends every key to a slot of its own, with no slot left over, whose entry holds shard,
offset, length and a fingerprint that tells strange keys.  A key costs one displacement,
one entry and one positioned read, however many documents there are.
"""

from __future__ import annotations

import json
import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import _BYTE, SPACES, lean, longs, mix, slices, small_side, span_hashes, table, word_spans
from palimpsest.session import DROP_SHUFFLES_CONF, scratch_dir, written

END_ID = 1
#: Bytes of text per shard, on average.
SHARD_BYTES = 32 * 1024 * 1024
PART_KEYS = 20_000
#: Bytes of text whose equal words are put together at once.
ENCODED_BYTES = 2_000_000
#: Bytes of text that are split and hashed at once.
NAMED_BYTES = 250_000
MAGIC = b"ids+foot"
#: Words, and parts of words, kept with their ids in a worker, and the longest one kept.
KNOWN_PIECES = 1 << 18
LONGEST_KNOWN = 64
#: Displacements tried at once.
TRIES = 16
ENTRY = np.dtype([("print", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u4")])
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Copies of one id that are listed in one task.
CHUNK = 100_000


# ---------------------------------------------------------------- encoding

#: What a vocabulary of words ends that drops white space normalises and splits by.
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def words_apart(spec: dict) -> bool:
    """Whether white space never reaches a token nor changes one, so that words can be encoded one by one."""
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        (spec.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS
        and split[0] == {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
        and [(s.get("type"), s.get("add_prefix_space"), s.get("use_regex")) for s in split[1:]] == [("ByteLevel", False, False)]
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or len(t["content"].split()) != 1 for t in spec.get("added_tokens", []))
        and not spec.get("truncation")
    )


#: What a byte is in a word that needs no encode: a letter, a digit, another sign, or a
#: reason to encode the whole word (the apostrophe, controls, all other scripts).
LETTER, DIGIT, SIGN, ODD = 1, 2, 3, 4
_KIND = np.full(256, ODD, np.uint8)
_KIND[0x21:0x7F] = SIGN
_KIND[0x27] = ODD
_KIND[0x30:0x3A] = DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = LETTER
#: U+00C0 to U+00FF but for the two signs among them are letters: 0xC3 and one of these bytes.
_AFTER_C3 = np.zeros(256, bool)
_AFTER_C3[0x80:0xC0] = True
_AFTER_C3[[0x97, 0xB7]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


class Known:
    """Ids of parts by two hashes of their bytes; of bounded size: as many as `most` new ones, and those of the round before.

    Columns in the order of the first hash, some 30 bytes a part, and looked up for a whole
    slice at once: a dictionary of as many parts takes a worker hundreds of MB.
    """

    def __init__(self, kind: str, most: int = KNOWN_PIECES):
        none = np.zeros(0, np.uint64)
        self.most, self.empty = most, (none, none, np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, kind))
        self.new = self.old = self.empty

    def find(self, name: np.ndarray, other: np.ndarray, make, fit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, and where each part's start in them and how many they are); make gives those of the numbered parts.

        Parts that fit are kept; their first hashes ascend, all different.
        """
        first, size = np.zeros(len(name), np.int64), np.full(len(name), -1, np.int64)
        base, known = 0, []
        for names, others, at, n, flat in (self.new, self.old):
            if len(names):
                place = np.minimum(np.searchsorted(names, name), len(names) - 1)
                hit = (size < 0) & (names[place] == name) & (others[place] == other)
                first[hit], size[hit] = at[place[hit]] + base, n[place[hit]]
            known.append(size >= 0)
            base += len(flat)
        missing = np.flatnonzero(size < 0)
        made = make(missing)
        size[missing] = np.fromiter(map(len, made), np.int64, len(made)) // self.empty[4].itemsize
        first[missing] = base + np.cumsum(size[missing]) - size[missing]
        ids = np.concatenate([self.new[4], self.old[4], np.frombuffer(b"".join(made), self.empty[4].dtype)])
        added = np.flatnonzero(fit & ~known[0])[: self.most]
        if len(self.new[0]) + len(added) > self.most:
            self.old, self.new = self.new, self.empty
        names, others, at, n, flat = self.new
        count = size[added]
        start = np.cumsum(count) - count
        own = ids[np.repeat(first[added] - start, count) + np.arange(count.sum())]
        place = np.searchsorted(names, name[added])
        columns = ((names, name[added]), (others, other[added]), (at, start + len(flat)), (n, count))
        self.new = (*(np.insert(have, place, more) for have, more in columns), np.concatenate([flat, own]))
        return ids, first, size


class Encoder:
    """Ids of texts as bytes.

    Where words_apart allows it, the words of a slice are split by their bytes, equal parts
    are put together, and the vocabulary's model gets each part once, which is what encode
    does with it at a third of the cost.  Words with other signs than ASCII and Latin
    letters go through encode, and so do texts that hold a special token's text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = id_width(self.tokenizer.get_vocab_size())
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = words_apart(spec)
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.known = Known(f"<u{self.width}")

    def _encoded(self, text: bytes) -> bytes:
        return np.asarray(self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids, f"<u{self.width}").tobytes()

    def _part(self, part: bytes) -> bytes:
        shown = part.decode() if part.isascii() else part.decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(self.width, "little") for t in self.model.tokenize(shown)])

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text of a slice."""
        whole = data.tobytes()
        if not self.by_word:
            return [self._encoded(whole[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        if any(text in whole for text in self.special):
            own = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            special = [any(text in x.tobytes() for text in self.special) for x in own]
            return [self._encoded(x.tobytes()) if s else self._by_parts(x, np.array([0, len(x)]))[0] for x, s in zip(own, special, strict=True)]
        return self._by_parts(data, offsets)

    def _by_parts(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        shown, begin, end, odd, name, other = named(data, offsets)
        if not len(begin):
            return [b""] * (len(offsets) - 1)
        _, first, which = np.unique(name, return_index=True, return_inverse=True)
        fit = (end - begin)[first] <= LONGEST_KNOWN
        if (other != other[first][which]).any():  # two parts of one name: no part is put together with another
            first = which = np.arange(len(begin))
            fit = np.zeros(len(begin), bool)
        text = shown.tobytes()

        def made(missing: np.ndarray) -> list[bytes]:
            at = first[missing]
            return [(self._encoded if o else self._part)(text[a:b]) for a, b, o in zip(begin[at].tolist(), end[at].tolist(), odd[at].tolist(), strict=True)]

        flat, place, size = self.known.find(name[first], other[first], made, fit)
        per = size[which]
        stop = np.cumsum(per)
        taken = flat[np.repeat(place[which] - (stop - per), per) + np.arange(stop[-1])]
        edges = np.append(0, stop)[np.searchsorted(begin, offsets)].tolist()
        return [taken[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in small letters, start and end of each part, whether it is a word for encode, whose bytes stay as they are)."""
    starts, ends, _ = word_spans(data, offsets)
    kind = _KIND[data]
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & _AFTER_C3[data[1:]]
    kind[second] = LETTER
    kind[:-1][second[1:]] = LETTER
    space = SPACES[data]
    reasons = np.append(0, np.cumsum((kind == ODD) & ~space))
    odd = reasons[ends] > reasons[starts]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[odd]] += 1
    edge[ends[odd]] -= 1
    kept = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    shown = _LOWER[data]
    shown[second & (data < 0x9F)] += 32
    shown = np.where(kept, data, shown)
    new = kind == DIGIT
    new[1:] |= kind[1:] != kind[:-1]
    new &= ~kept & ~space
    new[starts] = True
    begin = np.flatnonzero(new)
    word = np.searchsorted(starts, begin, side="right") - 1
    end = np.minimum(np.append(begin[1:], len(data)), ends[word]) if len(begin) else begin
    return shown, begin, end, odd[word] if len(begin) else np.zeros(0, bool)


def named(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """split's columns and two hashes of each part; made of some texts at a time, for it takes many numbers for each byte."""
    found, row = [], 0
    while row < len(offsets) - 1:
        base = offsets[row]
        last = max(row + 1, int(np.searchsorted(offsets, base + NAMED_BYTES, side="right")) - 1)
        shown, begin, end, odd = split(data[base : offsets[last]], offsets[row : last + 1] - base)
        name = span_hashes(shown, begin, end, _BYTE) ^ odd.astype(np.uint64)
        found.append((shown, begin + base, end + base, odd, name, span_hashes(shown, begin, end, _BYTE[::-1])))
        row = last
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def id_width(vocabulary: int) -> int:
    return 2 if max(vocabulary, END_ID + 1) <= 1 << 16 else 4


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ---------------------------------------------------------------- shards


def write_shards(docs: DataFrame, path: str, tokenizer: str, id_col: str, text_col: str, shard_bytes: int = SHARD_BYTES) -> int:
    """Write the shards below path and return the bytes of an id."""
    width = encoder(tokenizer).width
    end = END_ID.to_bytes(width, "little")
    rows = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.xxhash64(text_col).alias("_k"),
        # parts rows that are equal in all else, which would otherwise all go to one shard
        F.monotonically_increasing_id().alias("_salt"),
    )
    size = rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
    order = ["_id", "_k", "_salt"]
    dealt = rows.repartitionByRange(max(1, math.ceil(size / shard_bytes)), *order).sortWithinPartitions(*order)
    kind = pa.field("id", _arrow_type(rows.select("_id")))

    def encoded(batches):
        code, ids, lengths = encoder(tokenizer), [], []
        for batch in batches:
            values = [ids for _, _, data, offsets in slices(batch, "_text", ENCODED_BYTES) for ids in code.ids(data, offsets)]
            ids.append(batch.column(0).cast(kind.type))
            lengths += [len(v) // width + 1 for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], ["value"])
        if lengths:
            sink = pa.BufferOutputStream()
            footer = pa.RecordBatch.from_arrays([pa.concat_arrays(ids), longs(lengths)], ["id", "n"])
            with pa.ipc.new_stream(sink, footer.schema) as stream:
                stream.write_batch(footer)
            footer = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_arrays([pa.array([footer + struct.pack("<Q", len(footer)) + MAGIC], pa.binary())], ["value"])

    spark = docs.sparkSession
    out = dealt.select("_id", "_text").mapInArrow(lean(encoded), "value binary").select(F.col("value").cast("string").alias("value"))
    before = spark.conf.get(DROP_SHUFFLES_CONF)
    spark.conf.set(DROP_SHUFFLES_CONF, "true")
    try:
        out.write.option("lineSep", end.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    finally:
        spark.conf.set(DROP_SHUFFLES_CONF, before)
    return width


def _arrow_type(one: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(one.schema[0].dataType)


def _contents(spark: SparkSession, path: str) -> DataFrame:
    """(shard, content): a file is read by one task, files up to the session's partition size together."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0")
    return files.select(F.regexp_extract("path", r".*/part-(\d+)", 1).cast("long").alias("shard"), "content")


def parsed(content: pa.Scalar, width: int) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """A shard's footer, the first id of each document, and all its ids."""
    data = content.as_buffer()
    tail = len(data) - width
    size = struct.unpack("<Q", data.slice(tail - 16, 8).to_pybytes())[0]
    if data.slice(tail - 8, 8).to_pybytes() != MAGIC:
        raise ValueError("a shard without its footer")
    footer = pa.ipc.open_stream(data.slice(tail - 16 - size, size)).read_next_batch()
    at = np.append(0, np.cumsum(footer.column(1).to_numpy()))
    if at[-1] * width != tail - 16 - size:
        raise ValueError("a shard's length is not that of its documents")
    return footer, at, np.frombuffer(data, f"<u{width}", int(at[-1]))


# ---------------------------------------------------------------- the index


def _hashes(key):
    """Two hashes of a key's text."""
    return F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")


def key_text(id_, copy):
    return F.concat(copy.cast("string"), F.when(id_.isNull(), "").otherwise(F.concat(F.lit(":"), id_.cast("string"))))


def key_hashes(id_, copy: int = 0) -> tuple[int, int]:
    """The same on the driver, for one key."""
    text = (f"{copy}" if id_ is None else f"{copy}:{id_}").encode()
    second = xxhash.xxh64_intdigest(struct.pack("<i", 7), 42)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(xxhash.xxh64_intdigest(text, 42)), signed(xxhash.xxh64_intdigest(text, second))


def _mixed(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key: what picks its bucket, what a displacement moves, its fingerprint."""
    a, b = mix(h1.astype(np.int64).view(np.uint64)), mix(h2.astype(np.int64).view(np.uint64) + _ODD)
    return a, a ^ b, (b >> np.uint64(32)).astype(np.uint32)


def minimal_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement of each bucket, slot of each key): n keys, n buckets, n slots.

    Large buckets first, each takes the first displacement that sends all its keys to
    free slots; buckets of one key name a free slot (as -1 - slot).
    """
    n = len(h1)
    pick, moved, _ = _mixed(h1, h2)
    bucket = (pick % np.uint64(n)).astype(np.int64)
    seeds = np.zeros(n, np.int32)
    slots = np.full(n, -1, np.int64)
    free = np.ones(n, bool)
    by_bucket = np.argsort(bucket, kind="stable")
    count = np.bincount(bucket, minlength=n)
    first = np.cumsum(count) - count
    large = np.flatnonzero(count > 1)
    for b in large[np.argsort(-count[large], kind="stable")].tolist():
        keys = by_bucket[first[b] : first[b] + count[b]]
        if len(np.unique(moved[keys])) < len(keys):
            raise ValueError("two keys with equal hashes")
        start = 1
        while True:
            d = np.arange(start, start + TRIES, dtype=np.uint64) * _ODD
            to = (mix(moved[keys][None, :] ^ d[:, None]) % np.uint64(n)).astype(np.int64)
            good = free[to].all(axis=1)
            ordered = np.sort(to, axis=1)
            good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                k = int(good.argmax())
                seeds[b], slots[keys] = start + k, to[k]
                free[to[k]] = False
                break
            start += TRIES
    single = np.flatnonzero(count == 1)
    rest = np.flatnonzero(free)
    seeds[single] = -1 - rest
    slots[by_bucket[first[single]]] = rest
    return seeds, slots


def slots_of(h1: np.ndarray, h2: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The slot of each key; that of a key the part was not built from is any slot."""
    n = np.uint64(len(seeds))
    pick, moved, _ = _mixed(h1, h2)
    d = seeds[(pick % n).astype(np.int64)].astype(np.int64)
    to = mix(moved ^ (np.maximum(d, 0).astype(np.uint64) * _ODD)) % n
    return np.where(d < 0, -1 - d, to.astype(np.int64))


def _built(frame: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = frame["h1"].to_numpy(), frame["h2"].to_numpy()
    seeds, slots = minimal_hash(h1, h2)
    entries = np.zeros(len(frame), ENTRY)
    entries["print"][slots] = _mixed(h1, h2)[2]
    for name in ("shard", "at", "n"):
        entries[name][slots] = frame[name].to_numpy()
    return pd.DataFrame({"part": [frame["part"].iloc[0]], "keys": [len(frame)], "seeds": [seeds.tobytes()], "entries": [entries.tobytes()]})


def _found(h1: np.ndarray, h2: np.ndarray, seeds: bytes, entries: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(entries, whether each is the key's) of keys of one part."""
    got = np.frombuffer(entries, ENTRY)[slots_of(h1, h2, np.frombuffer(seeds, np.int32))]
    return got, got["print"] == _mixed(h1, h2)[2]


@dataclass(frozen=True)
class Store:
    """Shards and index below one folder."""

    spark: SparkSession
    root: str
    width: int
    parts: int
    #: (shard, row, id, run, at, n, crc) of every document, read back from the shards.
    documents: DataFrame
    #: (shard, base, start, rows): copies of a shard's first id in earlier shards, ids before it, documents before it.
    shards: DataFrame

    def keys(self) -> DataFrame:
        """(_id, copy, shard, at, n): every document's key and place, from the shards' footers."""
        copy = F.col("run") + F.when(F.col("row") == F.col("run"), F.col("base")).otherwise(0)
        return self.documents.join(small_side(self.shards), "shard").select(F.col("id").alias("_id"), copy.alias("copy"), "shard", "at", "n")

    def locate(self, keys: DataFrame) -> DataFrame:
        """(_id, copy, shard, at, n) of the keys (_id, copy) by the index; null places for keys that are not there."""
        asked = keys.select("_id", "copy").distinct()
        asked = asked.select("_id", "copy", *_hashes(key_text(F.col("_id"), F.col("copy")))).withColumn("part", F.pmod("h1", F.lit(self.parts)))
        index = self.spark.read.parquet(f"{self.root}/index")
        kind = keys.schema["_id"].dataType.simpleString()

        def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
            h1, h2 = (left.column(name).to_numpy() for name in ("h1", "h2"))
            if right.num_rows and left.num_rows:
                got, there = _found(h1, h2, right.column("seeds")[0].as_py(), right.column("entries")[0].as_py())
            else:
                got, there = np.zeros(len(h1), ENTRY), np.zeros(len(h1), bool)
            places = [pa.array(got[name].astype(np.int64), mask=~there) for name in ("shard", "at", "n")]
            return pa.Table.from_arrays([left.column("_id"), left.column("copy"), *places], ["_id", "copy", "shard", "at", "n"])

        return asked.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(looked_up, f"_id {kind}, copy long, shard long, at long, n long")

    def read(self, located: DataFrame) -> DataFrame:
        """(_id, copy, ids): the ids at located places; a shard is opened once, whatever is asked of it."""
        wanted = located.filter("shard IS NOT NULL").groupBy("shard").agg(F.collect_list(F.struct("_id", "copy", "at", "n")).alias("asked"))
        kind = located.schema["_id"].dataType.simpleString()
        width = self.width

        def cut(batches):
            for batch in batches:
                for content, asked in zip(batch.column(0), batch.column(1), strict=True):
                    ids = parsed(content, width)[2]
                    rows = asked.values
                    take = [ids[a : a + n].astype(np.int64) for a, n in zip(rows.field(2).to_pylist(), rows.field(3).to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([rows.field(0), rows.field(1), pa.array(take, pa.list_(pa.int64()))], ["_id", "copy", "ids"])

        return _contents(self.spark, f"{self.root}/shards").join(wanted, "shard").select("content", "asked").mapInArrow(cut, f"_id {kind}, copy long, ids array<long>")

    def get(self, id_, copy: int = 0) -> np.ndarray | None:
        """One document's ids: one index part, one entry, one positioned read."""
        h1, h2 = key_hashes(id_, copy)
        part = self.spark.read.parquet(f"{self.root}/index").filter(F.col("part") == h1 % self.parts).first()
        if part is None:
            return None
        got, there = _found(np.array([h1]), np.array([h2]), bytes(part["seeds"]), bytes(part["entries"]))
        if not there[0]:
            return None
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.root}/shards")
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        name = files.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"part-{int(got['shard'][0]):05d}-*"))[0].getPath()
        size = int(got["n"][0]) * self.width
        stream = files.open(name)
        try:
            stream.seek(int(got["at"][0]) * self.width)
            data = bytes(jvm.org.apache.commons.io.IOUtils.readFully(stream, size))
        finally:
            stream.close()
        return np.frombuffer(data, f"<u{self.width}")


def write(
    docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, part_keys: int = PART_KEYS
) -> Store:
    """Encode all documents to shards in ascending order of id, read them back and index them.

    Null texts count as empty: a document of the end id alone.  Null ids come first; rows
    that repeat an id are told apart by a copy number, in the order of their texts' hash.
    An empty table makes a store without shards.  Very long texts make a long shard, for a
    document is never cut.  Other columns are not read.
    """
    spark = docs.sparkSession
    width = write_shards(docs, f"{root}/shards", tokenizer, id_col, text_col, shard_bytes)
    kind = docs.schema[id_col].dataType.simpleString()

    def listed(batches):
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                footer, at, ids = parsed(content, width)
                rows = len(at) - 1
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                names = footer.column(0).to_pylist()
                run = np.zeros(rows, np.int64)
                for k in range(1, rows):
                    if names[k] == names[k - 1]:
                        run[k] = run[k - 1] + 1
                columns = [longs(np.full(rows, shard)), longs(np.arange(rows)), footer.column(0), longs(run), longs(at[:-1]), footer.column(1), longs(crc)]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "row", "id", "run", "at", "n", "crc"])

    found = _contents(spark, f"{root}/shards").mapInArrow(lean(listed), f"shard long, row long, id {kind}, run long, at long, n long, crc long")
    found = written(found, "token-documents")
    store = Store(spark, root, width, max(1, math.ceil(found.count() / part_keys)), found, written(_shards(found), "token-shards"))
    keyed = store.keys().select(*_hashes(key_text(F.col("_id"), F.col("copy"))), "shard", "at", "n").withColumn("part", F.pmod("h1", F.lit(store.parts)))
    index = keyed.groupBy("part").applyInPandas(_built, "part long, keys long, seeds binary, entries binary")
    index.write.parquet(f"{root}/index")
    return store


def _shards(found: DataFrame) -> DataFrame:
    """One row per shard: ids and documents before it, and copies of its first id at the end of earlier shards."""
    each = found.groupBy("shard").agg(
        F.count("*").alias("docs"), F.sum("n").alias("ids"), F.min_by("id", "row").alias("first"), F.max_by("id", "row").alias("last"), (F.max_by("run", "row") + 1).alias("tail")
    )
    order = Window.orderBy("shard")  # rows are shards
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    each = each.select(
        "*",
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"),
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("rows"),
        F.coalesce(F.lag("last").over(order).eqNullSafe(F.col("first")) & F.lag("shard").over(order).isNotNull(), F.lit(False)).alias("goes_on"),
    )
    begins = F.when((F.col("tail") < F.col("docs")) | ~F.col("goes_on"), F.col("rows") + F.col("docs") - F.col("tail"))
    each = each.withColumn("begins", begins).withColumn("run_from", F.last("begins", True).over(before))
    return each.select("shard", F.when(F.col("goes_on"), F.col("rows") - F.col("run_from")).otherwise(0).alias("base"), "start", "rows")


def _asked(docs: DataFrame, id_col: str) -> DataFrame:
    """(_id, copy): the keys of all rows."""
    counts = docs.groupBy(F.col(id_col).alias("_id")).agg(F.count("*").alias("times"))
    some = counts.select("_id", "times", F.explode(F.expr(f"sequence(0L, (times - 1) div {CHUNK})")).alias("chunk"))
    last = F.least(F.col("times"), (F.col("chunk") + 1) * CHUNK) - 1
    return some.repartition("_id", "chunk").select("_id", F.explode(F.sequence(F.col("chunk") * CHUNK, last)).alias("copy"))


def report(docs: DataFrame, root: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row per input row, looked up in the index: doc_id, ids before it, ids of it, crc32 of its ids."""
    store = write(docs, root, tokenizer, id_col, text_col, **settings)
    located = store.locate(_asked(docs, id_col))
    read = store.documents.select(F.col("shard").alias("_s"), F.col("at").alias("_a"), "crc")
    placed = located.join(small_side(store.shards.select("shard", "start")), "shard", "left")
    placed = placed.join(read, (F.col("shard") == F.col("_s")) & (F.col("at") == F.col("_a")), "left")
    return placed.select(
        F.col("_id").alias(id_col), (F.col("start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )


def op13_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return report(table(spark, sf_dir, "documents"), scratch_dir(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
