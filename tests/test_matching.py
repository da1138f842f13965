"""One-scan matching by row address: against brute force, and what its plans must not do."""

import random

import pytest

from palimpsest.operators import erasure, matching, needles, row_address
from palimpsest.operators.registry import TableRules
from palimpsest.session import BROADCAST_BYTES_CONF
from palimpsest.sources.rewrite import erase_files
from pyspark.sql import functions as F

NAMES = ["Ada", "Bo", "Al", "Li", "Éva", "😀na", "A", "Bo Al"]
HOSTS = ["x.org", "x.org.uk", "é.io", "x"]
GLUE = ["", " ", "😀", "<", "s", ".", "\n", "é", "=", "-", "😀😀"]


def requests(spark, rows):
    full = [(f"R{k:03d}", f, s, e, t, "PENDING") for k, (f, s, e, t) in enumerate(rows)]
    return spark.createDataFrame(full, "request_id string, first_name string, last_name string, email string, request_type string, status string")


def people(rng, n):
    out = []
    for _ in range(n):
        first, last = rng.choice([*NAMES, None, ""]), rng.choice([*NAMES, None])
        email = f"{rng.choice(['ada', 'da', 'a.b', '😀', 'b'])}@{rng.choice(HOSTS)}" if rng.random() < 0.7 else None
        out.append((first, last, email, rng.choice(["DELETE", "OBFUSCATE", None])))
    return out


def text(rng, asked):
    parts = [x for row in rng.sample(asked, 3) for x in row[:3] if x]
    rng.shuffle(parts)
    return "".join(rng.choice(GLUE) + p for p in parts) + rng.choice(GLUE)


def whole(t, e):
    start = 0
    while (k := t.find(e, start)) >= 0:
        before, after = t[k - 1 : k] if k else "", t[k + len(e) : k + len(e) + 2]
        alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
        longer = (before and before in alnum + "._%+-") or (after and (after[0] in alnum + "-" or (after[0] == "." and after[1:] and after[1] in alnum)))
        if not longer:
            return True
        start = k + 1
    return False


def matches(rules, rule, row, request, whole_address=False, lower=False):
    """(usable, matched) by the definitions, for one row and one request."""
    first, last, email, _ = (x if x and x.strip() else None for x in request)
    full = f"{first} {last}" if first and last else None
    low = (lambda x: x.lower() if x else x) if lower else (lambda x: x)
    email = low(email)
    if not email and not full:
        return False, False
    docs = [row[p] for p in rules.payloads]

    def inside(t, e):
        return t is not None and (whole(low(t), e) if whole_address else e in low(t))

    pairs = [(row[c], {"first_name": first, "last_name": last, "full_name": full}[r]) for c, r in rules.names]
    mails = [low(row[c]) for c in rules.emails]
    if rule == matching.EMAIL_FIRST:
        if rules.emails and email:
            return True, email in mails
        if rules.payloads:
            if email:
                return True, any(inside(t, email) for t in docs)
            return True, any(t is not None and first in t and last in t for t in docs)
        return (True, all(a == b for a, b in pairs)) if rules.names_suffice and full else (False, False)
    if (rules.emails or rules.payloads) and not email or (rules.names or rules.payloads) and not full:
        return False, False
    if not rules.emails and not rules.payloads and not rules.names_suffice:
        return False, False
    same = all(a == b for a, b in pairs) and all(m == email for m in mails)
    return True, same and all(inside(t, email) and first in t and last in t for t in docs)


TABLES = {
    "payloads": TableRules("t", payloads=("doc", "more"), masked=("doc", "more"), columns=("doc", "more")),
    "payload and email": TableRules("t", emails=("email",), payloads=("doc",), names=(("fn", "first_name"),), columns=("email", "doc")),
    "emails and names": TableRules("t", emails=("email", "email2"), names=(("fn", "first_name"), ("ln", "last_name")), columns=("email",)),
    "first name alone": TableRules("t", names=(("fn", "first_name"),), columns=("fn",)),
    "full name": TableRules("t", names=(("full", "full_name"),), columns=("full",)),
}


CASES = [(name, None, {}) for name in TABLES]
CASES += [("payloads", None, {"whole_address": True}), ("payload and email", None, {"case_insensitive": True}), ("payload and email", 0, {})]


@pytest.mark.parametrize("name, limit, options", CASES)
def test_both_rules_from_one_scan(spark, name, limit, options):
    rules = TABLES[name]
    rng = random.Random(len(name) + len(options))
    asked = people(rng, 25)
    rows = []
    for k in range(60):
        f, s, e, _ = rng.choice(asked)
        doc = rng.choice([None, text(rng, asked), text(rng, asked), "", "😀" * 3])
        up = (lambda x: x.upper() if x and rng.random() < 0.3 else x) if options.get("case_insensitive") else (lambda x: x)
        rows.append({"id": k, "email": up(e), "email2": rng.choice([None, e, "z@z"]), "fn": f, "ln": s, "full": f"{f} {s}", "doc": up(doc), "more": text(rng, asked)})
    rows += [{**rows[3], "id": 60 + k} for k in range(5)]  # equal payloads
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id int, email string, email2 string, fn string, ln string, full string, doc string, more string")
    if limit is not None:
        spark.conf.set(BROADCAST_BYTES_CONF, str(limit))
    try:
        subjects = matching.subjects_of(requests(spark, asked), options.get("case_insensitive", False))
        both = (matching.EMAIL_FIRST, matching.ALL_IDENTIFIERS)
        found = matching.find(df.repartition(3), rules, subjects, both, **options)
        for rule in both:
            verdicts = [[matches(rules, rule, r, a, options.get("whole_address"), options.get("case_insensitive")) for a in asked] for r in rows]
            counts = {f"R{j:03d}": sum(v[j][1] for v in verdicts) for j in range(len(asked)) if verdicts[0][j][0]}
            assert {r[0]: r[1] for r in found.counts(rule).collect()} == counts
            code = [2 if t == "DELETE" else 1 for *_, t in asked]
            modes = [max([c for c, (_, hit) in zip(code, v, strict=True) if hit], default=0) for v in verdicts]
            assert [r[matching.MODE] for r in found.flagged(rule).orderBy("id").collect()] == modes
            flagged = matching.flag_rows(df, rules, subjects, rule, **options)
            assert [r[matching.MODE] for r in flagged.orderBy("id").collect()] == modes
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)


@pytest.mark.parametrize("seed", range(2))
def test_occurrences_same_as_nested_loop(spark, seed):
    rng = random.Random(seed)
    word = lambda lo, hi: "".join(rng.choice('abAB1.@é 😀\n"]') for _ in range(rng.randint(lo, hi)))
    base = [word(1, 25) for _ in range(50)]
    texts = [(k, word(0, 8) + rng.choice(base) + word(0, 5) + rng.choice(base), rng.choice([None, "", word(0, 40)])) for k in range(100)]
    wanted = sorted({b[: rng.randint(1, len(b))] for b in base})
    df = spark.createDataFrame(texts, "i int, a string, b string")
    prepared = needles.prepare(spark.createDataFrame([(w,) for w in wanted], "needle string"))
    found = {tuple(r) for r in needles.occurrences(df, ["i"], ["a", "b"], prepared).collect()}
    assert found == {(k, c, w) for k, a, b in texts for c, t in (("a", a), ("b", b)) for w in wanted if t and w in t}


def nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_payload_is_shuffled_or_joined_on(spark, tmp_path):
    rows = spark.range(400).select("id", F.concat(F.lit("mail a"), (F.col("id") % 7).cast("string"), F.lit("@x.org")).alias("doc"))
    rows.repartition(8).write.parquet(str(tmp_path / "t"))
    rules = TableRules("t", payloads=("doc",), masked=("doc",), columns=("doc",))
    subjects = matching.subjects_of(requests(spark, [("", "", "a3@x.org", "DELETE"), ("", "", "a4@x.org", "OBFUSCATE")]))
    table = spark.read.parquet(str(tmp_path / "t"))
    erased = erasure.erase_table(table, rules, subjects)
    plan = nodes(erased)
    # only narrow rows meet, by address; the table is scanned by the join with what was found, and shuffled by nothing
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(_file") and "SortMergeJoin" not in plan
    assert plan.count("FileScan parquet") == 2
    assert erased.count() == 400 - 57
    # beyond the broadcast limit, files are joined in slices, each of which reads its own files
    spark.conf.set(BROADCAST_BYTES_CONF, "3000")
    try:
        found = matching.find(table, rules, subjects)
        assert found.flagged().groupBy(matching.MODE).count().count() == 3
        assert {r[0]: r[1] for r in found.flagged().groupBy(matching.MODE).count().collect()} == {0: 286, 1: 57, 2: 57}
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)


def test_frames_that_are_no_scan_are_written_first(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert "addressed" not in nodes(row_address.addressed(table.where("id > 2").select((F.col("id") * 2).alias("k"))))
    twice = table.select("id", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    assert row_address.addressed(twice).select("_file", "_row").distinct().count() == 20


def test_files_without_a_match_are_not_written(spark, tmp_path):
    path = tmp_path / "t"
    rows = [(k, f"note a{k}@x.org" if k % 10 else "note all@x.org", k // 10) for k in range(100)]
    df = spark.createDataFrame(rows, "id int, doc string, part int")
    df.repartition("part").write.partitionBy("part").parquet(str(path))
    rules = TableRules("t", payloads=("doc",), masked=("doc",), columns=("doc",))
    before = {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in path.rglob("*.parquet")}
    asked = [("", "", "a41@x.org", "DELETE"), ("", "", "a42@x.org", "OBFUSCATE"), *[("", "", f"a{k}@x.org", "DELETE") for k in range(71, 80)]]
    asked.append(("", "", "nobody@x.org", "DELETE"))
    done = erase_files(spark, str(path), rules, matching.subjects_of(requests(spark, asked)))
    assert done == {"files": 10, "rewritten": 2, "removed": 0}
    after = {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in path.rglob("*.parquet")}
    changed = {f.parent.name for f in before if after.get(f, (0, b""))[1] != before[f][1]}
    assert changed == {"part=4", "part=7"} and set(after) == set(before)
    left = {r["id"]: r["doc"] for r in spark.read.parquet(str(path)).collect()}
    assert len(left) == 100 - 10 and 41 not in left and 71 not in left and 70 in left
    gone = erase_files(spark, str(path), rules, matching.subjects_of(requests(spark, [("", "", "all@x.org", "DELETE")])))
    assert gone == {"files": 10, "rewritten": 9, "removed": 1}
