"""Find many short strings in many texts without comparing every pair.

A ``contains`` join is a nested loop: every text against every string.  Here
each searched string (a *needle*) is filed under one substring of itself, its
*anchor*.  A text can only contain the needle if it contains the anchor, so texts
and needles meet by an equality join on substrings of the text, and the few
pairs that meet are checked with ``contains``.  The result is exactly that of
the nested loop.

Anchors are chosen so that a text is cut in few places.  An address is filed
under the characters around its ``@``, and texts are cut only around theirs.
Any other needle is filed under a window that few needles share and that starts
with a character texts hold few of (a capital, a digit); texts are cut only at
characters some anchor starts with.

With a needle set that fits a measured broadcast, the texts are never shuffled:
scan, cut, probe and check run in one stage.  Otherwise the join shuffles the
substrings, and adaptive execution splits a hot one.

``occurrences`` never carries a text: each cut takes as many characters around it
along as the longest needle needs, and that context alone settles what stands there.
``search`` carries whole rows, and any number of parts per pattern.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import broadcast_limit, written

# Window sizes for needles without an address.
WINDOW_SIZES = (8, 5, 3, 2, 1)
# Characters up to and including the @, and characters after it.
BEFORE_AT = (13, 9, 7, 5, 4, 3, 2, 1)
AFTER_AT = (8, 4, 0)
# Up to so many anchors texts are asked for them before anything leaves the scan.
FEW_ANCHORS = 5000
# A window shared by more needles than this is avoided if the needle has a rarer one.
_SHARED_BY_FEW = 64

PARTS = ("needle", "also1", "also2")
ROLE = "_role"
# Matches nothing.  A pattern that holds a character beyond 16 bits looks back by characters;
# any other one looks back by 16-bit units and would miss what follows an emoji.
_BY_CHARACTERS = "(?:|\U0001F600)"
# Stands for what is before a text and after it; no character, so no identifier holds it.
_EDGE = "\uffff"
# An address goes on to the left, or to the right, with these.
_ADDRESS_BEFORE = "[A-Za-z0-9._%+-]"
_ADDRESS_AFTER = r"^([A-Za-z0-9-]|\.[A-Za-z0-9])"


def _windows(text: Column, trigger: str, reach: int, size: int) -> Column:
    """The windows of ``size`` characters whose ``reach``-th character is a ``trigger`` (a regex for one character).

    Only the trigger is consumed, so the scan runs from trigger to trigger and
    overlapping windows are all found; the window itself is captured by looking
    ahead from ``reach`` characters back.
    """
    return F.regexp_extract_all(
        text, F.lit(f"(?s){trigger}(?<=(?=(.{{{size}}})).{{{reach}}}){_BY_CHARACTERS}"), F.lit(1)
    )


def _largest(sizes: tuple[int, ...], limit: Column) -> Column:
    return F.coalesce(*[F.when(limit >= size, size) for size in sizes])


def _class_of(characters: str) -> str:
    """A regex class of the given characters; all of them if none are given."""
    if not characters:
        return "."
    return "[" + "".join(c if c.isalnum() else f"\\{c}" for c in characters) + "]"


@dataclass(frozen=True)
class NeedleSet:
    """Distinct patterns with their anchor, ready to be searched for.

    ``frame`` has ``needle, also1, also2, anchor`` plus whatever columns the
    caller kept per pattern, and ``_lead``, the place of the cut's character in the
    needle; a text matches when it contains all non-null parts.  ``marks`` lists the
    windows a text is cut into: the characters they start at (or @), reach and size.
    ``before`` and ``after`` are the most characters a needle has up to and after a cut.
    """

    frame: DataFrame
    marks: tuple[tuple[str, int, int], ...]
    before: int
    after: int
    broadcastable: bool
    #: The anchors themselves, by whether they are of addresses, where they are few enough to stand in a plan.
    few: Mapping[bool, frozenset[str]] = field(default_factory=dict)

    @property
    def cuts(self) -> tuple[tuple[str, int, int], ...]:
        return tuple((start if start == "@" else _class_of(start), reach, size) for start, reach, size in self.marks)

    @property
    def join_side(self) -> DataFrame:
        return F.broadcast(self.frame) if self.broadcastable else self.frame


def prepare(patterns: DataFrame) -> NeedleSet:
    """Choose anchors.  ``patterns`` has one row per distinct (needle, also1, also2)."""
    return prepare_roles(patterns.withColumn(ROLE, F.lit("any")), ("any",))["any"]


def prepare_roles(patterns: DataFrame, roles: tuple[str, ...]) -> dict[str, NeedleSet]:
    """Several needle sets at once, told apart by the column ``_role``.

    The anchored patterns are written to the scratch folder (they are read at
    least twice); one aggregate over them reads their size and the kinds of
    windows in use, of which there are only so many.
    """
    for name in PARTS:
        if name not in patterns.columns:
            patterns = patterns.withColumn(name, F.lit(None).cast("string"))
    columns = patterns.columns
    size = F.char_length("needle")
    at = F.instr("needle", "@")
    sized = patterns.where(size > 0)

    reach = _largest(BEFORE_AT, at)
    addresses = sized.where(at > 0).select(
        *columns,
        reach.alias("_reach"),
        (reach + _largest(AFTER_AT, size - at)).alias("_size"),
        at.alias("_at"),
    )
    addresses = addresses.select(
        *columns,
        "_reach",
        "_size",
        F.expr("substring(needle, _at - _reach + 1, _size)").alias("anchor"),
        F.lit("@").alias("_start"),
        F.col("_at").alias("_lead"),
    )

    windows = F.coalesce(
        *[F.when(F.col("_size") == w, _windows(F.col("needle"), ".", 1, w)) for w in WINDOW_SIZES]
    )
    cut = (
        sized.where(at == 0)
        .withColumn("_size", _largest(WINDOW_SIZES, size))
        .withColumn("anchor", F.explode(F.array_distinct(windows)))
    )
    uses = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("_uses"))
    choice = F.struct(
        (F.col("_uses") > _SHARED_BY_FEW).alias("crowded"),
        F.col("anchor").rlike(r"^[\p{Ll}\s]").alias("common_start"),
        F.col("_uses"),
        F.col("anchor"),
    )
    others = (
        cut.join(uses, "anchor")
        .groupBy(*columns, "_size")
        .agg(F.min(choice).getField("anchor").alias("anchor"))
        .select(
            *columns, F.lit(1).alias("_reach"), "_size", "anchor", F.substring("anchor", 1, 1).alias("_start"),
            F.expr("instr(needle, anchor)").alias("_lead"),
        )
    )

    frame = written(addresses.unionByName(others), "needles")
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in PARTS), F.lit(96))
    kinds = (
        frame.groupBy(ROLE, (F.col("_start") == "@").alias("address"), "_reach", "_size")
        .agg(
            F.sum(width).alias("bytes"),
            F.array_join(F.sort_array(F.collect_set("_start")), "").alias("starts"),
            F.max("_lead").alias("before"),
            F.max(size - F.col("_lead")).alias("after"),
            F.count(F.lit(1)).alias("needles"),
        )
        .collect()
    )
    counts = Counter()
    for k in kinds:
        counts[k[ROLE], k["address"]] += k["needles"]
    # a few names beside many addresses are still few
    some, total = [], 0
    for kind in sorted(counts, key=lambda kind: (counts[kind], kind)):
        total += counts[kind]
        some += [kind] if total <= FEW_ANCHORS else []
    few = {(role, address): set() for role in roles for address in (True, False) if not counts[role, address] or (role, address) in some}
    if some:
        wanted = reduce(lambda x, y: x | y, [(F.col(ROLE) == role) & ((F.col("_start") == "@") == address) for role, address in some])
        for r in frame.where(wanted).select(ROLE, (F.col("_start") == "@").alias("address"), "anchor").distinct().collect():
            few[r[ROLE], r["address"]].add(r["anchor"])
    small = sum(k["bytes"] for k in kinds) <= broadcast_limit(patterns.sparkSession)
    frame = frame.drop("_reach", "_size", "_start")

    def one(role: str) -> NeedleSet:
        own = [k for k in kinds if k[ROLE] == role]
        marks = sorted(("@" if k["address"] else k["starts"], k["_reach"], k["_size"]) for k in own)
        before, after = (max((k[side] for k in own), default=0) for side in ("before", "after"))
        named = {address: frozenset(few[role, address]) for address in (True, False) if (role, address) in few}
        return NeedleSet(frame.where(F.col(ROLE) == role).drop(ROLE), tuple(marks), before, after, small, named)

    return {role: one(role) for role in roles}


def _contains_all(text: str) -> Column:
    test = F.contains(F.col(text), F.col("needle"))
    for part in PARTS[1:]:
        test = test & (F.col(part).isNull() | F.contains(F.col(text), F.col(part)))
    return test


def search(df: DataFrame, texts: list[str], needles: NeedleSet) -> DataFrame:
    """Rows of ``df`` joined to every pattern one of its ``texts`` contains, once per (row, pattern)."""
    pieces = [_windows(F.coalesce(F.col(t), F.lit("")), *cut) for t in texts for cut in needles.cuts]
    empty = F.array().cast("array<string>")
    grams = F.array_distinct(F.concat(*pieces)) if pieces else empty
    found = _contains_all(texts[0])
    for text in texts[1:]:
        found = F.coalesce(found, F.lit(False)) | F.coalesce(_contains_all(text), F.lit(False))
    return (
        df.withColumn("_gram", F.explode(grams))
        .join(needles.join_side, F.col("_gram") == F.col("anchor"))
        .where(found)
        .drop("_gram", "anchor", "_lead")
    )


# --- occurrences, without the texts ------------------------------------------------------


@dataclass(frozen=True)
class Cuts:
    """Where texts are cut for several needle sets together, and how much is taken along."""

    #: Class of characters, (reach, size) ..., and the anchors if they are few.
    marks: tuple[tuple[str, tuple[tuple[int, int], ...], frozenset[str] | None], ...]
    before: int
    after: int

    @classmethod
    def of(cls, sets: Iterable[NeedleSet]) -> "Cuts":
        marks = [m for s in sets for m in s.marks]
        grouped = []
        for address in (True, False):
            own = [m for m in marks if (m[0] == "@") == address]
            if own:
                starts = "@" if address else _class_of("".join(sorted({c for m in own for c in m[0]})))
                few = frozenset().union(*(s.few[address] for s in sets)) if all(address in s.few for s in sets) else None
                grouped.append((starts, tuple(sorted({(reach, size) for _, reach, size in own})), few))
        # one character more than any needle on the left and two on the right tell whether it goes on
        return cls(tuple(grouped), max((s.before for s in sets), default=0) + 1, max((s.after for s in sets), default=0) + 2)

    def entries(self, document: Column, **tags: Column) -> Column:
        """Array of ``tags, gram, context`` for one text."""
        # everything a needle's first characters can reach back to is in the context, or is the edge
        padded = F.concat(F.lit(_EDGE * (self.before - 1)), F.coalesce(document, F.lit("")), F.lit(_EDGE * self.after))

        def gram(context: Column, reach: int, size: int) -> Column:
            return F.substring(context, self.before - reach + 1, size)

        def cut(shapes: tuple[tuple[int, int], ...]):
            def entry(context: Column, shape: tuple[int, int]) -> Column:
                named = [value.alias(name) for name, value in tags.items()]
                return F.struct(*named, gram(context, *shape).alias("gram"), context.alias("context"))

            return lambda context: F.array(*[entry(context, shape) for shape in shapes])

        def known(shapes: tuple[tuple[int, int], ...], few: frozenset[str]):
            """Whether an anchor stands at the cut: most contexts end here."""
            tests = [(shape, [a for a in few if len(a) == shape[1]]) for shape in shapes]
            return lambda context: reduce(lambda x, y: x | y, [gram(context, *shape).isin(anchors) for shape, anchors in tests if anchors])

        found = []
        for starts, shapes, few in self.marks:
            contexts = F.array_distinct(_windows(padded, starts, self.before, self.before + self.after))
            if few is not None:
                contexts = F.filter(contexts, known(shapes, few))
            found.append(F.flatten(F.transform(contexts, cut(shapes))))
        return F.concat(*found)

    def holds(self, context: str, needle: str, lead: str, whole: bool = False) -> Column:
        """Whether the needle stands at the cut; ``whole``: and is no part of a longer address."""
        start = f"{self.before} - {lead} + 1"
        same = F.expr(f"substring({context}, {start}, char_length({needle})) = {needle}")
        if not whole:
            return same
        left = F.expr(f"substring({context}, {start} - 1, 1)").rlike(_ADDRESS_BEFORE)
        right = F.expr(f"substring({context}, {start} + char_length({needle}), 2)").rlike(_ADDRESS_AFTER)
        return same & (~F.expr(f"contains({needle}, '@')") | (~left & ~right))


def occurrences(df: DataFrame, keep: list[str], texts: list[str], needles: NeedleSet, whole: bool = False) -> DataFrame:
    """``keep, text, needle``: which needle stands in which text column of a row, each once per row of ``keep``.

    Only the kept columns and the contexts leave the scan.  Patterns of one part.
    """
    cuts = Cuts.of([needles])
    if not cuts.marks:
        return df.select(*keep, F.lit("").alias("text"), F.lit("").alias("needle")).limit(0)
    entries = F.concat(*[cuts.entries(F.col(t), text=F.lit(t)) for t in texts])
    pieces = df.select(*keep, F.explode(entries).alias("_e")).select(*keep, "_e.*")
    hits = pieces.join(needles.join_side, F.col("gram") == F.col("anchor")).where(cuts.holds("context", "needle", "_lead", whole))
    return hits.select(*keep, "text", "needle").distinct()
