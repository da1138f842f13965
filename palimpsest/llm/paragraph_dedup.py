"""Substring dedup: near-equal paragraphs by MinHash bands, exact checks and components.

A paragraph is a line, and each piece of a long line between cuts that depend on the
words around them only, so a passage copied into the middle of other text is cut alike.
Where a piece repeats, the equal words around it and the one that stays go as well.
Bands are tuned to a recall, the chance of a pair at the threshold to collide in one.
All that collide are compared by the exact Jaccard similarity of their word shingles:
first each with the band's pivot; then those that did not link with it among themselves
and with the others, unless a component holds both already or their sketches (parities
of their shingles' bits, which differ in no more bits than the sets in shingles) rule a
link out.  In a crowded band, what its largest component does not hold meets a few of
that component first, round by round, so a crowd of near copies is one component before
all that is left is compared.  Linked ones are clustered, and one occurrence of each
cluster stays.

A paragraph leaves its text as a class name, 32 bits per band and its place; sets and
sketches are made again from the texts for the few classes that share a band with
another.  Bands are dealt a few at a time, and what was dealt goes before the next ones.
Equal paragraphs are one class: the smallest and the largest class of a key are
aggregated before the shuffle, so a paragraph that stands in a third of all texts is one
row of a task there; its occurrences meet its fate in a join that broadcasts, or that
adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import STEP, blobs, components, keyed, lean, longs, mix, parities, slices, small_side, span_hashes, table, word_spans
from palimpsest.session import dropped, written

WIDTH = 5
SIMILAR = 0.75
RECALL = 0.98
#: Of one row, a key would be a single shingle, which in a common phrase holds many unrelated paragraphs.
ROWS = 3
#: Words of 64 bits in a sketch.
SKETCH = 8
#: So many members of a band outside its largest component are a crowd; it meets about so many of that component a round.
CROWD, PIVOTS = 32, 16
#: Bands dealt at once.
WAVE = 2
#: A word cuts a line if its hash is the smallest of so many words on either side.
REACH = 9
#: Shorter pieces are no paragraphs of their own (two cuts are as far apart at least); whole lines are from WIDTH words on.
MIN_WORDS = REACH + 1


def bands(similar: float = SIMILAR, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of so many rows that reach the recall at the threshold."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similar**rows)))


BANDS = bands()


class Paragraphs:
    """Paragraphs of a slice: text, byte span, shingle range, class and, when asked for, band keys."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        starts, ends, first = word_spans(data, offsets)
        words = span_hashes(data, starts, ends)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        line = np.cumsum(data == 10)[starts] if len(starts) else starts
        new = np.ones(len(words), bool)
        new[1:] = (line[1:] != line[:-1]) | (doc[1:] != doc[:-1])
        part = np.cumsum(new)
        cut = np.ones(len(words), bool)
        for k in range(1, REACH + 1):
            near = part[k:] == part[:-k]
            cut[k:] &= ~near | (words[k:] < words[:-k])
            cut[:-k] &= ~near | (words[:-k] <= words[k:])
        self.words, self.starts, self.ends = words, starts, ends
        self.cuts = np.append(np.flatnonzero(new | cut), len(words))
        self.lines = np.append(np.flatnonzero(new), len(words))
        begin, end = self.cuts[:-1], self.cuts[1:]
        keep = end - begin >= MIN_WORDS
        wide = np.diff(self.lines) >= WIDTH
        begin = np.concatenate([self.lines[:-1][wide], begin[keep]])
        end = np.concatenate([self.lines[1:][wide], end[keep]])
        self.begin, self.stop = begin, end
        # Lines link with lines and pieces with pieces: no paragraph links with one that overlaps it.
        piece = (np.arange(len(begin)) >= wide.sum()).astype(np.uint64)
        self.doc = doc[begin]
        self.start = starts[begin] - offsets[self.doc]
        self.end = ends[end - 1] - offsets[self.doc]
        n = len(words) - WIDTH + 1
        rolled = np.zeros(max(0, n), np.uint64)
        for k in range(WIDTH if n > 0 else 0):
            rolled += words[k : n + k] * STEP[k]
        self.rolled = mix(rolled)
        self.first, self.last = begin, end - WIDTH + 1
        self.wide = np.append(self.rolled, np.uint64(0))
        self.piece = piece * STEP[6]
        if not len(begin):
            self.edges, self.cls = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        self.edges = np.stack([self.first, self.last], axis=1).ravel()
        self.edges[-1] = min(self.edges[-1], len(self.rolled))
        self.cls = mix(np.add.reduceat(mix(self.wide + np.uint64(11)), self.edges)[::2] ^ self.piece).view(np.int64)

    def keys(self) -> list[np.ndarray]:
        """32 bits of every paragraph's key, one array per band."""
        if not len(self.cls):
            return [np.zeros(0, np.int32)] * BANDS
        keys = []
        for band in range(BANDS):
            got = np.uint64(band + 1) + self.piece
            for row in range(ROWS):
                salted = mix(self.wide ^ STEP[10 + band * ROWS + row])
                salted[-1] = np.iinfo(np.uint64).max
                got = mix(got * STEP[5] + np.minimum.reduceat(salted, self.edges)[::2])
            keys.append((got >> np.uint64(32)).astype(np.uint32).view(np.int32))
        return keys

    def around(self, k: int) -> tuple[int, int]:
        """The words of the pieces next to the paragraph, and REACH more on either side, in its line.

        A passage that went on farther would have the cut, and so the neighbour, in common.
        """
        a, b = self.begin[k], self.stop[k]
        line = np.searchsorted(self.lines, a, side="right")
        low = self.cuts[max(0, np.searchsorted(self.cuts, a) - 1)] - REACH
        high = self.cuts[min(len(self.cuts) - 1, np.searchsorted(self.cuts, b) + 1)] + REACH
        return max(low, self.lines[line - 1]), min(high, self.lines[line])

    def tokens(self, k: int) -> bytes:
        return np.unique(self.rolled[self.first[k] : self.last[k]]).tobytes()


KEYS = [f"b{k}" for k in range(BANDS)]
BITS = [f"s{k}" for k in range(SKETCH)]


def paragraphs(rows: DataFrame) -> DataFrame:
    """(cls, 32 bits of a key per band, _k1, _k2, place) of every paragraph; place holds its byte span."""

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(k).to_numpy() for k in (0, 1))
            for row, _, data, offsets in slices(batch, "_text"):
                p = Paragraphs(data, offsets)
                d = row + p.doc
                keys = [pa.array(key, pa.int32()) for key in p.keys()]
                columns = [longs(p.cls), *keys, longs(k1[d]), longs(k2[d]), longs((p.start << 32) | p.end)]
                yield pa.RecordBatch.from_arrays(columns, ["cls", *KEYS, "_k1", "_k2", "place"])

    schema = ", ".join(["cls long", *[f"{name} int" for name in KEYS], "_k1 long, _k2 long, place long"])
    return rows.select("_k1", "_k2", "_text").mapInArrow(lean(run), schema)


def classes_of(found: DataFrame) -> DataFrame:
    """(cls, n, at, band keys): each distinct paragraph once, counted, with its smallest place."""
    at = F.min(F.struct("_k1", "_k2", "place")).alias("at")
    return found.groupBy("cls").agg(F.count("*").alias("n"), at, *[F.min(name).alias(name) for name in KEYS])


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, tokens) of the wanted paragraphs (cls, _k1, _k2), one of each class."""
    lists = written(wanted.groupBy("_k1", "_k2").agg(F.collect_list("cls").alias("classes")), "paragraph-wanted")
    texts = rows.join(small_side(lists), ["_k1", "_k2"]).select("_text", "classes")

    def run(batches):
        for batch in batches:
            for row, n, data, offsets in slices(batch, "_text"):
                p = Paragraphs(data, offsets)
                asked = [set(c) for c in batch.column(1).slice(row, n).to_pylist()]
                take = [k for k, (d, c) in enumerate(zip(p.doc.tolist(), p.cls.tolist(), strict=True)) if c in asked[d]]
                yield pa.RecordBatch.from_arrays([longs(p.cls[take]), blobs([p.tokens(k) for k in take])], ["cls", "tokens"])

    return texts.mapInArrow(lean(run), "cls long, tokens binary").dropDuplicates(["cls"])


def _sets_of(pairs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, tokens) of the classes that stand in pairs (cls, other)."""
    named = written(pairs.select("cls").union(pairs.select("other")).distinct(), "paragraph-named")
    wanted = classes.select("cls", "at._k1", "at._k2").join(small_side(named), "cls").groupBy("cls").agg(F.min(F.struct("_k1", "_k2")).alias("k"))
    return written(_sets(rows, wanted.select("cls", "k._k1", "k._k2")), "paragraph-sets")


def _sketches(sets: DataFrame) -> DataFrame:
    """(cls, size, sketch) of sets of shingles."""

    def run(batches):
        for batch in batches:
            for row, n, data, offsets in slices(batch, "tokens"):
                sizes = np.diff(offsets) // 8
                bits = map(longs, parities(data.view(np.uint64), sizes, SKETCH).T)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, n), longs(sizes), *bits], ["cls", "size", *BITS])

    return sets.mapInArrow(lean(run), ", ".join(f"{name} long" for name in ("cls", "size", *BITS)))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, near) of the pairs (cls, other): whether their exact similarity reaches the threshold."""
    sides = pairs.join(sets.select(F.col("cls").alias("other"), F.col("tokens").alias("tb")), "other").join(sets, "cls")

    def run(batches):
        for batch in batches:
            fits = []
            for ta, tb in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(ta.as_buffer(), np.uint64), np.frombuffer(tb.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(x, y), len(x) - 1)
                same = int((x[at] == y).sum())
                fits.append(same >= SIMILAR * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fits, pa.bool_())], ["u", "v", "near"])

    return sides.select("cls", "other", "tokens", "tb").mapInArrow(lean(run), "u long, v long, near boolean")


def _few(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets of the classes that stand in pairs (cls, other)."""
    named = written(pairs.select("cls").union(pairs.select("other")).distinct(), "paragraph-named")
    return written(sets.join(small_side(named), "cls"), "paragraph-few")


OTHER = ["cls", "component", "size", *BITS]


def _others(members: DataFrame) -> DataFrame:
    return members.select("key", *[F.col(name).alias(f"x_{name}") for name in OTHER])


def _may_link() -> str:
    """Between members of different components: sizes and sketches allow a link."""
    differ = " + ".join(f"bit_count({name} ^ x_{name})" for name in BITS)
    return (
        f"component <> x_component AND least(size, x_size) >= {SIMILAR} * greatest(size, x_size)"
        f" AND ({differ}) <= {(1 - SIMILAR) / (1 + SIMILAR) + 1e-9} * (size + x_size)"
    )


def _drawn_in(rest: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """rest with the components that links in crowded bands make, and those links (u, v).

    A crowd goes on meeting others of the largest component as long as a tenth of it
    links; what it leaves is compared with the whole band by the caller.
    """
    found = None
    for turn in count():
        parts = rest.groupBy("key", "component").agg(F.count("*").alias("n"))
        tops = parts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"))
        tops = tops.filter(f"top.n > 1 AND all - top.n > {CROWD}").selectExpr("key", "top.component AS top", "top.n AS n")
        tops = written(tops, "paragraph-tops")
        if tops.isEmpty():
            return rest, found
        crowded = rest.join(small_side(tops), "key")
        pivots = crowded.filter(f"component = top AND pmod(xxhash64(cls, {turn}), {1 << 20}) * n < {PIVOTS << 20}")
        pivots = written(_others(pivots), "paragraph-drawn")
        outside = crowded.filter("component <> top")
        pairs = outside.join(small_side(pivots), "key").filter(_may_link())
        pairs = pairs.select("cls", F.col("x_cls").alias("other"), "component", "x_component").distinct()
        pairs = written(pairs, "paragraph-tried")
        hits = _verified(pairs.select("cls", "other"), _few(sets, pairs)).filter("near")
        hits = written(hits.selectExpr("u AS cls", "v AS other"), "paragraph-hits")
        links = hits.selectExpr("cls AS u", "other AS v")
        found = links if found is None else found.unionAll(links)
        edges = pairs.join(hits, ["cls", "other"]).selectExpr("component AS u", "x_component AS v")
        moved = written(components(edges, "paragraph-moves").selectExpr("node AS component", "component AS top"), "paragraph-moved")
        rest = rest.join(small_side(moved), "component", "left").withColumn("component", F.coalesce("top", "component"))
        rest = written(rest.drop("top"), "paragraph-rest")
        if 10 * hits.select("cls").distinct().count() < outside.select("cls").distinct().count():
            return rest, found


def linked(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(u, v): links between classes that collide in a band, all of them up to pairs of one component.

    classes may hold a class more than once.  Pivots are a written table, so that the
    join with a band of many classes is one between plain scans, which adaptive
    execution splits.
    """
    waves = []
    for first in range(0, BANDS, WAVE):
        keys = [F.expr(f"shiftleft({band}L, 32) | ({KEYS[band]} & 4294967295L)") for band in range(first, min(first + WAVE, BANDS))]
        entries = classes.select(F.explode(F.array(*keys)).alias("key"), "cls")
        pivots = entries.groupBy("key").agg(F.min("cls").alias("pivot"), F.max("cls").alias("other"))
        pivots = written(pivots.filter("pivot < other").select("key", "pivot"), "paragraph-pivots")
        met = entries.join(small_side(pivots), "key").filter("cls <> pivot")
        waves.append(written(met.groupBy("key", "cls").agg(F.min("pivot").alias("pivot")), "paragraph-met"))
    members = reduce(DataFrame.unionAll, waves)
    pairs = written(members.select("cls", F.col("pivot").alias("other")).distinct(), "paragraph-pairs")
    sets = _sets_of(pairs, rows, classes)
    known = written(_verified(pairs, sets), "paragraph-known")
    near = known.filter("near").select("u", "v")
    joined = written(components(near, "paragraph-first"), "paragraph-joined")

    crowded = written(members.groupBy("key").agg(F.count("*").alias("others")).filter("others > 1").select("key"), "paragraph-crowded")
    rest = members.join(small_side(crowded), "key").join(known.selectExpr("u AS cls", "v AS pivot", "near"), ["cls", "pivot"])
    rest = rest.join(_sketches(sets), "cls").join(joined.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    rest = written(rest.select("key", "cls", "near", "component", "size", *BITS), "paragraph-rest")
    rest, drawn = _drawn_in(rest, sets)
    again = _others(rest.filter("NOT near")).join(rest, "key").filter(f"(near OR cls < x_cls) AND {_may_link()}")
    again = written(again.select(F.greatest("cls", "x_cls").alias("cls"), F.least("cls", "x_cls").alias("other")).distinct(), "paragraph-again")
    near = near if drawn is None else near.unionAll(drawn)
    return near.unionAll(_verified(again, _few(sets, again)).filter("near").select("u", "v"))


def spans_to_remove(rows: DataFrame) -> DataFrame:
    """(_k1, _k2, spans): byte spans of the paragraphs that repeat one that stays."""
    found = written(paragraphs(rows), "paragraph-places")
    links = linked(rows, found.select("cls", *KEYS, F.struct("_k1", "_k2", "place").alias("at")))
    grouped = written(components(links, "paragraph-components").withColumnRenamed("node", "cls"), "paragraph-grouped")
    keys, found = found, written(found.select("cls", "_k1", "_k2", "place"), "paragraph-narrow")
    dropped(keys)
    again = found.groupBy("cls").agg(F.count("*").alias("n")).filter("n > 1").select("cls")
    fates = again.join(grouped, "cls", "full").select("cls", F.coalesce("component", "cls").alias("component"))
    fates = written(fates, "paragraph-fates")
    places = written(found.join(small_side(fates), "cls").drop("cls"), "paragraph-members")
    kept = written(places.groupBy("component").agg(F.min(F.struct("_k1", "_k2", "place")).alias("one")), "paragraph-kept")
    gone = places.join(small_side(kept), "component").filter(F.struct("_k1", "_k2", "place") != F.col("one"))
    gone = written(gone.select("_k1", "_k2", "place", "one").distinct(), "paragraph-gone")
    spans = gone.select("_k1", "_k2", F.shiftright("place", 32).alias("start"), F.expr("place & 4294967295").alias("end"))
    spans = spans.unionAll(_wider(rows, gone))
    return spans.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))


AROUND = "before binary, after binary, starts binary, ends binary"


def _around(rows: DataFrame, asked: DataFrame, all_of: bool) -> DataFrame:
    """(_k1, _k2, place, before, after, starts, ends): hashes and bytes of the words around the asked places.

    before and starts run to the left, away from the paragraph.  Unless all are wanted,
    a side on which another asked place goes on is left out.
    """
    asked = written(asked.groupBy("_k1", "_k2").agg(F.collect_set("place").alias("places")), "paragraph-asked")
    # most texts are asked for, and dealt by key at any size, so that what travels grows as the texts do
    asked = small_side(asked) if all_of else asked.hint("merge")
    texts = rows.join(asked, ["_k1", "_k2"]).select("_k1", "_k2", "_text", "places")

    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(k).to_pylist() for k in (0, 1))
            for row, n, data, offsets in slices(batch, "_text"):
                p = Paragraphs(data, offsets)
                places = [set(x) for x in batch.column(3).slice(row, n).to_pylist()]
                named = ((p.start << 32) | p.end).tolist()
                take = [k for k, (d, place) in enumerate(zip(p.doc.tolist(), named, strict=True)) if place in places[d]]
                firsts = np.sort(p.begin[take])
                far = np.append(0, np.maximum.accumulate(p.stop[take][np.argsort(p.begin[take], kind="stable")]))
                out = []
                for k in take:
                    a, b = int(p.begin[k]), int(p.stop[k])
                    low, high = p.around(k)
                    if not all_of:
                        low = a if far[np.searchsorted(firsts, a)] >= a else low
                        high = b if far[np.searchsorted(firsts, b, side="right")] > b else high
                    if low < a or high > b:
                        d, at = row + int(p.doc[k]), offsets[p.doc[k]]
                        left, right = slice(low, a), slice(b, high)
                        starts, ends = (p.starts[left][::-1] - at).tobytes(), (p.ends[right] - at).tobytes()
                        out.append((k1[d], k2[d], named[k], p.words[left][::-1].tobytes(), p.words[right].tobytes(), starts, ends))
                columns = list(zip(*out, strict=True)) or [[]] * 7
                names = ["_k1", "_k2", "place", "before", "after", "starts", "ends"]
                yield pa.RecordBatch.from_arrays([*(longs(c) for c in columns[:3]), *(blobs(c) for c in columns[3:])], names)

    return texts.mapInArrow(lean(run), f"_k1 long, _k2 long, place long, {AROUND}")


def _wider(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """(_k1, _k2, start, end): places that go, with the equal words around them and the place that stays.

    A place that stays is the smallest of its cluster, so what is equal stays at the
    smallest of its own places.
    """
    ours = written(_around(rows, gone.select("_k1", "_k2", "place"), False), "paragraph-ours")
    ours = ours.join(gone, ["_k1", "_k2", "place"]).distinct()
    ones = ours.select("one.*").distinct()
    theirs = _around(rows, ones, True).dropDuplicates(["_k1", "_k2", "place"])
    theirs = written(theirs.select(F.struct("_k1", "_k2", "place").alias("one"), F.col("before").alias("b"), F.col("after").alias("a")), "paragraph-theirs")
    sides = ours.join(small_side(theirs), "one").select("_k1", "_k2", "place", "before", "after", "starts", "ends", "b", "a")

    def equal(x, y):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        n = min(len(x), len(y))
        return int(np.append(x[:n] == y[:n], False).argmin())

    def run(batches):
        for batch in batches:
            begin, stop = [], []
            for place, before, after, starts, ends, b, a in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                left, right = equal(before, b), equal(after, a)
                begin.append(int(np.frombuffer(starts, np.int64)[left - 1]) if left else place >> 32)
                stop.append(int(np.frombuffer(ends, np.int64)[right - 1]) if right else place & 4294967295)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], longs(begin), longs(stop)], ["_k1", "_k2", "start", "end"])

    return sides.mapInArrow(run, "_k1 long, _k2 long, start long, end long")


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (the text that is left).

    Of a cluster, the occurrence with the smallest text hash and place stays.  Null and
    empty texts have no paragraphs; a paragraph that repeats inside one text is removed
    as well; rows equal in id and text are one text and keep alike.  Other columns are
    not read.
    """
    rows = keyed(docs, id_col, text_col)
    spans = written(spans_to_remove(rows), "paragraph-spans")
    joined = rows.join(spans.hint("merge"), ["_k1", "_k2"], "left")
    joined = joined.select("_id", "_text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            sizes, gone, count, kept = [], [], [], []
            for text, starts, ends in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                data = text.encode()
                sizes.append(len(data))
                spans = []
                for a, b in zip(starts or (), ends or (), strict=True):
                    if spans and a < spans[-1][1]:
                        spans[-1][1] = max(b, spans[-1][1])
                    else:
                        spans.append([a, b])
                edges = [0, *[x for pair in spans for x in pair], len(data)]
                left = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                gone.append(len(data) - len(left))
                count.append(len(spans))
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), longs(sizes), longs(gone), longs(count), pa.array(kept, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
