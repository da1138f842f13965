"""Which rows belong to which request.

Two rules: *email first* (an email match settles it, names are only a fallback)
and *all identifiers* (every registered identifier must agree).

``find`` reads a table once, whatever the rules asked for: the identifiers in its
columns and around the cuts of its payloads leave the scan as narrow rows with the
row's address, meet the requests' keys by equality, and are gathered per address.
From what it writes down, audits count rows per key and erasures take the mode of
every row, so neither reads a payload again.  Counting never multiplies rows: counts
are per key before they meet the requests, so one address that holds a third of all
rows costs one group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators import needles, row_address
from palimpsest.operators.registry import TableRules
from palimpsest.operators.row_address import FILE, ROW
from palimpsest.session import broadcast_if_small, fits_broadcast, written

EMAIL_FIRST, ALL_IDENTIFIERS = "email_first", "all_identifiers"

MODE = "_erase_mode"  # 2 = DELETE, 1 = OBFUSCATE, 0 = untouched
DELETE_CODE, OBFUSCATE_CODE = 2, 1

_ROLE_FIELD = {"first_name": "first", "last_name": "last", "full_name": "full"}


def mode_of(request_type: Column) -> Column:
    """DELETE only when asked for; everything else (also a missing type) redacts."""
    wanted = F.upper(F.trim(F.coalesce(request_type, F.lit(""))))
    return F.when(wanted == "DELETE", "DELETE").otherwise("OBFUSCATE")


def _code() -> Column:
    return F.when(F.col("request_type") == "DELETE", DELETE_CODE).otherwise(OBFUSCATE_CODE)


@dataclass(frozen=True)
class Subjects:
    """Requests as match keys, with one measurement of their size.

    ``frame`` is ``request_id, email, first, last, full, request_type``.  Key
    sets drawn from it are no larger than it is, so one measurement decides for
    all of them whether a join may broadcast.
    """

    frame: DataFrame
    small: bool
    _prepared: dict[object, object] = field(default_factory=dict, compare=False)

    def once(self, key: object, prepare: Callable[[], object]):
        """Needle sets under ``key``, prepared once for all tables and steps of a run."""
        if key not in self._prepared:
            self._prepared[key] = prepare()
        return self._prepared[key]

    def side(self, keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if self.small else keys


def subjects_of(requests: DataFrame, case_insensitive: bool = False) -> Subjects:
    """Requests as match keys; blanks are null, so they can never match anything.

    A request without an email and without both names has no usable key and is
    dropped here: as a substring it would match every row.
    """

    def filled(name: str) -> Column:
        return F.when(F.trim(F.col(name)) != "", F.col(name))

    email, first, last = filled("email"), filled("first_name"), filled("last_name")
    frame = requests.select(
        "request_id",
        (F.lower(email) if case_insensitive else email).alias("email"),
        first.alias("first"),
        last.alias("last"),
        F.concat(first, F.lit(" "), last).alias("full"),
        mode_of(F.col("request_type")).alias("request_type"),
    ).where(F.col("email").isNotNull() | F.col("full").isNotNull())
    return Subjects(frame, fits_broadcast(frame))


# --- email first: the three classes of requests on one table -----------------


def _by_email(rules: TableRules, subjects: DataFrame) -> DataFrame | None:
    return subjects.where("email is not null") if rules.emails else None


def _without_scalar_email(rules: TableRules, subjects: DataFrame) -> DataFrame:
    return subjects.where("email is null") if rules.emails else subjects


def _by_payload(rules: TableRules, subjects: DataFrame) -> DataFrame | None:
    """Payloads contain the email; only a request without one falls back to both names."""
    if not rules.payloads:
        return None
    rest = _without_scalar_email(rules, subjects)
    no_email = F.col("email").isNull()
    return rest.select(
        "request_id",
        "request_type",
        F.coalesce("email", "first").alias("needle"),
        F.when(no_email, F.col("last")).alias("also1"),
    )


def _by_name(rules: TableRules, subjects: DataFrame) -> DataFrame | None:
    if rules.payloads or not rules.names_suffice:
        return None
    return _without_scalar_email(rules, subjects).where("full is not null")


def _scalar_bindings(rules: TableRules, with_email: bool) -> list[tuple[str, str]]:
    """(table column, subject field) pairs that must be equal."""
    pairs = [(c, _ROLE_FIELD[role]) for c, role in rules.names]
    return ([(c, "email") for c in rules.emails] if with_email else []) + pairs


def _all_subjects(rules: TableRules, subjects: DataFrame) -> DataFrame:
    if rules.emails or rules.payloads:
        subjects = subjects.where("email is not null")
    if rules.names or rules.payloads:
        subjects = subjects.where("full is not null")
    return subjects


# --- one pass: rows by address, with the keys they match -----------------------

_KEY = ["rule", "kind", "a", "b", "c", "d"]
_SEPARATOR = "\u0001"


def _joined(values: list[Column]) -> Column:
    """Several values as one; null if any is."""
    parts = [values[0]]
    for value in values[1:]:
        parts += [F.lit(_SEPARATOR), value]
    return F.concat(*parts)


def _asked(rules: TableRules, subjects: DataFrame, which: tuple[str, ...]) -> list[DataFrame]:
    """``rule, kind, a, b, c, d, request_id, request_type``: what each request looks for in this table."""

    def keys(frame: DataFrame, rule: str, kind: str, a: Column, b=None, c=None, d=None) -> DataFrame:
        others = [F.lit("") if x is None else F.coalesce(x, F.lit("")) for x in (b, c, d)]
        named = [x.alias(n) for x, n in zip((F.lit(rule), F.lit(kind), a, *others), _KEY, strict=True)]
        return frame.select(*named, "request_id", "request_type").where("a is not null")

    asked = []
    if EMAIL_FIRST in which:
        by_email, by_payload, by_name = (f(rules, subjects) for f in (_by_email, _by_payload, _by_name))
        if by_email is not None:
            asked.append(keys(by_email, EMAIL_FIRST, "email", F.col("email")))
        if by_payload is not None:
            asked.append(keys(by_payload, EMAIL_FIRST, "needle", F.col("needle"), F.col("also1")))
        if by_name is not None:
            values = [F.col(f) for _, f in _scalar_bindings(rules, False)]
            asked.append(keys(by_name, EMAIL_FIRST, "names", _joined(values)))
    if ALL_IDENTIFIERS in which and rules.has_identifiers:
        people = _all_subjects(rules, subjects)
        values = [F.col(f) for _, f in _scalar_bindings(rules, True)]
        if rules.payloads:
            scalars = _joined(values) if values else None
            asked.append(keys(people, ALL_IDENTIFIERS, "payload", F.col("email"), F.col("first"), F.col("last"), scalars))
        elif rules.emails or rules.names_suffice:
            asked.append(keys(people, ALL_IDENTIFIERS, "all", _joined(values)))
    return asked


def _text_needles(rules: TableRules, subjects: Subjects, asked: DataFrame, which: tuple[str, ...]) -> dict[str, needles.NeedleSet]:
    """What is searched for in payloads: addresses, first names, last names."""
    pair = (F.col("kind") == "needle") & (F.col("b") != "")
    alone = (F.col("kind") == "needle") & (F.col("b") == "")
    every = F.col("kind") == "payload"
    roles = {
        "address": F.when(alone | every, F.col("a")),
        "first": F.when(pair, F.col("a")).when(every, F.col("b")),
        "last": F.when(pair, F.col("b")).when(every, F.col("c")),
    }
    parts = F.array(*[F.struct(F.lit(r).alias(needles.ROLE), v.alias("needle")) for r, v in roles.items()])
    return subjects.once(
        ("payload", which, bool(rules.emails)),
        lambda: needles.prepare_roles(
            asked.select(F.explode(parts).alias("p")).select("p.*").where("needle is not null").distinct(), tuple(roles)
        ),
    )


@dataclass(frozen=True)
class Matches:
    """What one scan of a table found.

    ``found`` (written) has one row per address and key: ``_file, _row, rule, kind, a, b,
    c, d, _code``; ``rows`` is the table with its addresses, and ``asked`` the requests'
    keys.
    """

    rows: DataFrame
    columns: tuple[str, ...]
    found: DataFrame | None
    asked: DataFrame | None
    subjects: Subjects

    def counts(self, rule: str = EMAIL_FIRST) -> DataFrame:
        """``request_id, rows_matched`` for each request with a usable predicate on this table (also zeros)."""
        if self.asked is None:
            none = F.lit(0).cast("long").alias("rows_matched")
            return self.subjects.frame.select("request_id", none).limit(0)
        hits = self.found.where(F.col("rule") == rule).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("rows_matched"))
        mine = self.asked.where(F.col("rule") == rule)
        return mine.join(self.subjects.side(hits), _KEY, "left").select(
            "request_id", F.coalesce("rows_matched", F.lit(0)).cast("long").alias("rows_matched")
        )

    def modes(self, rule: str = EMAIL_FIRST) -> DataFrame:
        """``_file, _row`` and the erase mode of the rows that any request matches."""
        return self.found.where(F.col("rule") == rule).groupBy(FILE, ROW).agg(F.max("_code").alias(MODE))

    def files(self, rule: str = EMAIL_FIRST) -> DataFrame:
        """The files that hold a matched row."""
        return self.found.where(F.col("rule") == rule).select(FILE).distinct()

    def flagged(self, rule: str = EMAIL_FIRST) -> DataFrame:
        """The table with its erase mode per row; a row several requests match is deleted if any says so."""
        if self.found is None:
            return self.rows.select(*self.columns, F.lit(0).alias(MODE))
        return row_address.marked(self.rows, self.modes(rule)).select(*self.columns, MODE)


def find(
    df: DataFrame,
    rules: TableRules,
    subjects: Subjects,
    which: tuple[str, ...] = (EMAIL_FIRST,),
    case_insensitive: bool = False,
    whole_address: bool = False,
) -> Matches:
    """Match a table against all requests under the given rules, in one scan.

    ``whole_address``: an address in a payload counts only where it is not part of a
    longer one (``andra.m@x.org`` in ``sandra.m@x.org``).
    """
    rows, columns = row_address.addressed(df), tuple(df.columns)
    asked = _asked(rules, subjects.frame, which)
    if not asked:
        return Matches(rows, columns, None, None, subjects)
    asked = reduce(DataFrame.unionByName, asked)
    kinds = {kind for kind, use in (
        ("email", EMAIL_FIRST in which and rules.emails), ("names", EMAIL_FIRST in which and rules.names_suffice and not rules.payloads),
        ("all", ALL_IDENTIFIERS in which and _scalar_bindings(rules, True)),
    ) if use}

    def value(column: str, fld: str) -> Column:
        return F.lower(column) if case_insensitive and fld == "email" else F.col(column)

    def scalar(kind: str, gram: Column) -> Column:
        return F.array(F.struct(
            F.lit("").alias("text"), F.lit(f"={kind}").alias("space"), gram.alias("gram"), F.lit(None).cast("string").alias("context")
        ))

    entries, anchors, holds = [], [], F.col("context").isNull()
    if "email" in kinds:
        entries += [scalar("email", value(c, "email")) for c in rules.emails]
    for kind, with_email in (("names", False), ("all", True)):
        if kind in kinds:
            entries.append(scalar(kind, _joined([value(c, f) for c, f in _scalar_bindings(rules, with_email)])))
    at_once = asked.where(F.col("kind").isin("email", "names", "all")).select(F.col("kind").alias("_role"), F.col("a").alias("_value"))
    if rules.payloads and "all" in kinds:
        at_once = at_once.unionByName(asked.where("kind = 'payload'").select(F.lit("all").alias("_role"), F.col("d").alias("_value")))
    anchors.append(at_once.distinct().select(
        F.concat(F.lit("="), "_role").alias("_space"), F.col("_value").alias("_gram"), "_role", "_value", F.lit(0).alias("_lead")
    ))
    small = subjects.small
    if rules.payloads:
        sets = _text_needles(rules, subjects, asked, which)
        small = small and all(s.broadcastable for s in sets.values())
        # names are shorter than addresses: they take less of a text along
        for space, roles in {"mail": ("address",), "name": ("first", "last")}.items():
            cuts = needles.Cuts.of([sets[r] for r in roles])
            if not cuts.marks:
                continue
            for text in rules.payloads:
                shown = F.lower(text) if space == "mail" and case_insensitive else F.col(text)
                entries.append(cuts.entries(shown, text=F.lit(text), space=F.lit(space)))
            holds = holds | ((F.col("space") == space) & cuts.holds("context", "_value", "_lead", whole_address))
            for role in roles:
                anchors.append(sets[role].frame.select(
                    F.lit(space).alias("_space"), F.col("anchor").alias("_gram"), F.lit(role).alias("_role"),
                    F.col("needle").alias("_value"), "_lead",
                ))
    codes = asked.groupBy(*_KEY).agg(F.max(_code()).alias("_code"))
    if not entries:
        none = rows.select(FILE, ROW).limit(0).crossJoin(codes.limit(0))
        return Matches(rows, columns, written(none, "matches"), asked, subjects)
    anchor = reduce(DataFrame.unionByName, anchors)
    anchor = F.broadcast(anchor) if small else anchor
    pieces = rows.select(FILE, ROW, F.explode(F.concat(*entries)).alias("_e")).select(FILE, ROW, "_e.*")
    hits = pieces.join(anchor, (F.col("space") == F.col("_space")) & (F.col("gram") == F.col("_gram"))).where(holds)
    atom = F.struct("text", F.col("_role").alias("role"), F.col("_value").alias("value"))
    gathered = hits.groupBy(FILE, ROW).agg(F.collect_set(atom).alias("atoms"))
    found = _keys_of(gathered, rules, which, subjects.side(codes))
    return Matches(rows, columns, written(found, "matches"), asked, subjects)


def _keys_of(gathered: DataFrame, rules: TableRules, which: tuple[str, ...], codes: DataFrame) -> DataFrame:
    """``_file, _row, <key>, _code``: from the identifiers found in a row to the requests' keys it matches."""

    def held(role: str, text: str | None = None) -> Column:
        wanted = lambda x: (x["role"] == role) & (F.lit(True) if text is None else x["text"] == text)
        return F.array_distinct(F.transform(F.filter("atoms", wanted), lambda x: x["value"]))

    def key(rule: str, kind: str, a: Column, b: Column | None = None) -> Column:
        blank = F.lit("")
        return F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), a.alias("a"), (blank if b is None else b).alias("b"), blank.alias("c"), blank.alias("d"))

    def pairs(text: str) -> Column:
        """Both names in one payload."""
        last = held("last", text)
        return F.flatten(F.transform(held("first", text), lambda f: F.transform(last, lambda v: key(EMAIL_FIRST, "needle", f, v))))

    direct = []
    if EMAIL_FIRST in which:
        direct.append(F.transform(held("email"), lambda v: key(EMAIL_FIRST, "email", v)))
        direct.append(F.transform(held("names"), lambda v: key(EMAIL_FIRST, "names", v)))
        direct.append(F.transform(held("address"), lambda v: key(EMAIL_FIRST, "needle", v)))
        direct += [pairs(text) for text in rules.payloads]
    if ALL_IDENTIFIERS in which and not rules.payloads:
        direct.append(F.transform(held("all"), lambda v: key(ALL_IDENTIFIERS, "all", v)))
    parts = []
    if direct:
        keys = gathered.select(FILE, ROW, F.explode(F.array_distinct(F.concat(*direct))).alias("k")).select(FILE, ROW, "k.*")
        parts.append(keys.join(codes, _KEY).select(FILE, ROW, *_KEY, "_code"))
    if ALL_IDENTIFIERS in which and rules.payloads:
        # addresses are the selective part: the names need only be looked up
        everywhere = reduce(F.array_intersect, [held("address", t) for t in rules.payloads])
        agree = [F.array_contains(held(r, t), F.col(c)) for t in rules.payloads for r, c in (("first", "b"), ("last", "c"))]
        if _scalar_bindings(rules, True):
            agree.append(F.array_contains(held("all"), F.col("d")))
        rows = gathered.select(FILE, ROW, "atoms", F.explode(everywhere).alias("a"))
        asked = codes.where((F.col("rule") == ALL_IDENTIFIERS) & (F.col("kind") == "payload"))
        parts.append(rows.join(asked, "a").where(reduce(lambda x, y: x & y, agree)).select(FILE, ROW, *_KEY, "_code"))
    return reduce(DataFrame.unionByName, parts)


def match_counts(
    df: DataFrame,
    rules: TableRules,
    subjects: Subjects,
    rule: str = EMAIL_FIRST,
    case_insensitive: bool = False,
    whole_address: bool = False,
) -> DataFrame:
    """``request_id, rows_matched`` for each request with a usable predicate on this table (also zeros)."""
    return find(df, rules, subjects, (rule,), case_insensitive, whole_address).counts(rule)


# --- flags: the erase mode of every row ---------------------------------------


def _flag_on(df, pairs, subjects, side, name, lower_email=False) -> DataFrame:
    """The mode of rows whose columns equal a request's fields."""
    fields = sorted({f for _, f in pairs})
    keys = subjects.groupBy(*fields).agg(F.max(_code()).alias(name))
    keys = keys.select(*[F.col(f).alias(f"_s_{f}") for f in fields], name)

    def equal(column: str, fld: str) -> Column:
        value = F.lower(column) if lower_email and fld == "email" else F.col(column)
        return value == F.col(f"_s_{fld}")

    same = reduce(lambda a, b: a & b, [equal(c, f) for c, f in pairs])
    return df.join(side(keys), same, "left").drop(*[f"_s_{f}" for f in fields])


def flag_rows(
    df: DataFrame,
    rules: TableRules,
    subjects: Subjects,
    rule: str = EMAIL_FIRST,
    case_insensitive: bool = False,
    whole_address: bool = False,
) -> DataFrame:
    """The table with its erase mode per row; a row several requests match is deleted if any says so.

    Requests that fit a broadcast meet plain columns within the scan.  Payloads, and any
    number of requests, go through ``find`` and the rows' addresses: no column of the table
    is shuffled.
    """
    if rules.payloads or not subjects.small:
        return find(df, rules, subjects, (rule,), case_insensitive, whole_address).flagged(rule)
    flags: list[str] = []
    people, side = subjects.frame, subjects.side

    def new_flag() -> str:
        flags.append(f"_m{len(flags)}")
        return flags[-1]

    columns = df.columns
    if rule == ALL_IDENTIFIERS:
        pairs = _scalar_bindings(rules, with_email=True)
        if pairs and (rules.emails or rules.names_suffice):
            df = _flag_on(df, pairs, _all_subjects(rules, people), side, new_flag(), case_insensitive)
    else:
        by_email = _by_email(rules, people)
        by_name = _by_name(rules, people)
        if by_email is not None:
            for column in rules.emails:
                df = _flag_on(df, [(column, "email")], by_email, side, new_flag(), case_insensitive)
        if by_name is not None:
            df = _flag_on(df, _scalar_bindings(rules, False), by_name, side, new_flag())
    found = [F.coalesce(f, F.lit(0)) for f in flags]
    mode = found[0] if len(found) == 1 else F.greatest(*found) if found else F.lit(0)
    return df.select(*columns, mode.alias(MODE))


# --- stable keys: email -> user ids --------------------------------------------


def resolve_subject_keys(raw: DataFrame, requests: DataFrame) -> DataFrame:
    """Per request, the user ids and original names its email stands for (before erasing).

    ``request_id, email, request_type, user_id, full_name``; one row per distinct
    combination, nothing collected.
    """
    asked = requests.select(
        "request_id",
        F.lower(F.trim("subject_email")).alias("email"),
        mode_of(F.col("request_type")).alias("request_type"),
    )
    wanted = broadcast_if_small(asked.select("email").distinct())
    people = (
        raw.select(F.lower("email").alias("email"), "user_id", "full_name")
        .join(wanted, "email")
        .distinct()
    )
    return asked.join(people, "email").select(
        "request_id", "email", "request_type", "user_id", "full_name"
    )


def user_modes(resolved: DataFrame) -> DataFrame:
    """One erase mode per user id; DELETE beats OBFUSCATE."""
    return resolved.groupBy("user_id").agg(F.max(_code()).alias(MODE))
