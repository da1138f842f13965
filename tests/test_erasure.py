import datetime as dt

import pytest
from pyspark.sql import functions as F

from palimpsest.functions.masking import ERASED_TOKEN
from palimpsest.operators import erasure, matching, registry, validation
from palimpsest.operators.registry import TableRules
from palimpsest.plans import scenarios, testdata
from palimpsest.session import BROADCAST_BYTES_CONF
from palimpsest.sources.rewrite import replace_table

QUEUE = (
    "request_id string, first_name string, last_name string, email string, request_type string, "
    "request_date date, deadline_date date, status string"
)
DAY = dt.date(2026, 7, 1)

SUBJECTS = [
    ("Marta", "Field", "marta.field@example.com", "DELETE"),
    ("Rick", "Jonas", "rick.jonas@example.com", "OBFUSCATE"),
    ("James", "O'Brien", "james.obrien@example.com", "DELETE"),
    ("Fatima", "Al-Sayed", "fatima.alsayed@example.com", "OBFUSCATE"),
]


def queue(spark, rows=None):
    rows = SUBJECTS if rows is None else rows
    return spark.createDataFrame(
        [(f"REQ-{i:04d}", f, n, e, t, DAY, DAY, "PENDING") for i, (f, n, e, t) in enumerate(rows, 1)], QUEUE
    )


def people(n=200):
    out = [(i, f"Bg{i % 7}", f"Person{i % 11}", f"user{i}@example.com") for i in range(n)]
    return out + [(1_000_000 + i, f, n_, e) for i, (f, n_, e, _) in enumerate(SUBJECTS)]


def tables(spark):
    rows = people()

    def payload(f, n, e):
        return (
            f'{{"appInfo":{{"appName":"skyward","name":"{f} {n}"}},'
            f'"documentLocation":"https://x/manage?firstName={f}&lastName={n}&email={e}&pnr=Z9"}}'
        )

    return {
        "customer_profile": spark.createDataFrame(
            [(i, f, n, e, "+1", "Road 1", "Oslo", 7) for i, f, n, e in rows],
            "customer_id long, first_name string, last_name string, email string, phone string, "
            "street_address string, home_city string, lifetime_revenue int",
        ),
        "contact_email_only": spark.createDataFrame(
            [(i, e, "+1", True) for i, f, n, e in rows], "contact_id long, email string, phone string, opt_in boolean"
        ),
        "booking": spark.createDataFrame(
            [(i, f"{f} {n}", "PNR1", "SW1", 5) for i, f, n, e in rows],
            "booking_id long, full_name string, pnr string, flight_no string, fare_usd int",
        ),
        "loyalty_split": spark.createDataFrame(
            [(i, f, n, "GOLD", 5) for i, f, n, e in rows],
            "member_id long, first_nm string, last_nm string, tier string, points int",
        ),
        "app_hits_json": spark.createDataFrame(
            [(i, payload(f, n, e), 9) for i, f, n, e in rows], "hit_id long, hit_payload string, revenue_usd int"
        ),
        "employee_crew": spark.createDataFrame(
            [(i, f, n, e, "OSL", "FA") for i, f, n, e in rows],
            "employee_id long, first_name string, last_name string, email string, base string, crew_role string",
        ),
    }


@pytest.fixture(scope="module")
def run(spark):
    """One live run over the six tables."""
    t = tables(spark)
    result = erasure.run_targets(
        spark, [erasure.Target("crm.people", t, testdata.registry(spark), queue(spark))], dry_run=False
    )
    return t, result


def test_audit_and_verdict(spark, run):
    _, result = run
    audit = result.audit.collect()
    assert len(audit) == 4 * 5
    assert {r["rows_matched"] for r in audit} == {1}
    assert {(r["request_type"], r["action"]) for r in audit} == {("DELETE", "deleted"), ("OBFUSCATE", "obfuscated")}
    assert result.findings.collect() == []
    assert tuple(result.summary.first()) == ("crm.people", 5, 20, "processed", "PASS")
    assert result.verdict.first()["verdict"] == "PASS"


def test_only_subjects_change(spark, run):
    before, result = run
    after = result.erased["crm.people"]
    assert set(after) == set(before) - {"employee_crew"}
    for name, df in after.items():
        key = df.columns[0]
        changes = validation.row_changes(before[name], df).collect()
        gone = {r[key] for r in changes if r["copies"] < 0}
        new = {r[key] for r in changes if r["copies"] > 0}
        assert gone == {1_000_000, 1_000_001, 1_000_002, 1_000_003}
        assert new == {1_000_001, 1_000_003}
    row = after["customer_profile"].where("customer_id = 1000001").first()
    assert row["first_name"] == row["email"] == row["phone"] == row["street_address"] == ERASED_TOKEN
    assert (row["home_city"], row["lifetime_revenue"]) == ("Oslo", 7)
    hit = after["app_hits_json"].where("hit_id = 1000001").first()["hit_payload"]
    assert "Rick" not in hit and "rick.jonas" not in hit
    assert "skyward" in hit and "pnr=Z9" in hit


def test_same_result_without_broadcasts(spark, run):
    before, result = run
    spark.conf.set(BROADCAST_BYTES_CONF, "0")
    try:
        again = erasure.run_targets(
            spark, [erasure.Target("crm.people", before, testdata.registry(spark), queue(spark))], dry_run=False
        )
        for name, df in again.erased["crm.people"].items():
            assert validation.row_changes(result.erased["crm.people"][name], df).isEmpty()
        assert again.audit.exceptAll(result.audit).isEmpty()
    finally:
        spark.conf.unset(BROADCAST_BYTES_CONF)


def test_dry_run_changes_nothing_and_says_so(spark):
    result = erasure.run_targets(spark, [erasure.Target("a.b", tables(spark), testdata.registry(spark), queue(spark))])
    assert result.erased == {}
    assert {r["action"] for r in result.audit.collect()} == {"dry_run"}
    assert result.verdict.first()["verdict"] == "dry_run"
    assert result.summary.first()["validation"] == "dry_run"


def test_no_match_is_no_match(spark):
    ghost = queue(spark, [("No", "Body", "nobody@nowhere.org", "DELETE")])
    t = tables(spark)
    rules = registry.rules_by_table(testdata.registry(spark))
    for dry in (True, False):
        rows = erasure.audit("x", t, rules, matching.subjects_of(ghost), dry_run=dry).collect()
        assert len(rows) == 5 and {r["action"] for r in rows} == {"no_match"}


def test_employee_scope(spark):
    t = tables(spark)
    result = erasure.run_targets(
        spark, [erasure.Target("a.b", t, testdata.registry(spark), queue(spark))], scope="employee", dry_run=False
    )
    assert list(result.erased["a.b"]) == ["employee_crew"]
    assert result.erased["a.b"]["employee_crew"].count() == 202


PAYLOAD_RULES = TableRules("p", payloads=("doc",), masked=("doc",), columns=("doc",))


def payloads(spark, *docs):
    return spark.createDataFrame(list(enumerate(docs)), "id int, doc string")


def modes(spark, df, requests, rules=PAYLOAD_RULES, rule=matching.EMAIL_FIRST):
    flagged = matching.flag_rows(df, rules, matching.subjects_of(requests), rule)
    return [r[matching.MODE] for r in flagged.orderBy("id").collect()]


def test_wildcards_in_an_address_are_literal(spark):
    df = payloads(spark, "x a_b@x.org", "x aXb@x.org", "x a%b@x.org")
    assert modes(spark, df, queue(spark, [("", "", "a_b@x.org", "DELETE")])) == [2, 0, 0]


def test_blank_request_matches_nothing(spark):
    df = payloads(spark, "anything", "at all")
    blanks = [("", "", "", "DELETE"), (None, None, None, "DELETE"), (" ", " ", " ", "DELETE"), ("Only", "", None, "DELETE")]
    assert modes(spark, df, queue(spark, blanks)) == [0, 0]
    assert matching.match_counts(df, PAYLOAD_RULES, matching.subjects_of(queue(spark, blanks))).collect() == []


def test_payload_falls_back_to_names_only_without_an_email(spark):
    df = payloads(spark, "Ada Ek", "Ada", "Ek", "ada@x.org", None)
    assert modes(spark, df, queue(spark, [("Ada", "Ek", None, "OBFUSCATE")])) == [1, 0, 0, 0, 0]
    assert modes(spark, df, queue(spark, [("Ada", "Ek", "ada@x.org", "OBFUSCATE")])) == [0, 0, 0, 1, 0]


def test_several_payloads_are_or_ed(spark):
    rules = TableRules("p", payloads=("doc", "more"), masked=("doc", "more"), columns=("doc", "more"))
    df = payloads(spark, "a@x.org", "-", "-").withColumn("more", F.when(F.col("id") == 1, "a@x.org"))
    assert modes(spark, df, queue(spark, [("", "", "a@x.org", "DELETE")]), rules) == [2, 2, 0]


def test_delete_wins_over_obfuscate(spark):
    asked = queue(spark, [("Ada", "Ek", "a@x.org", "OBFUSCATE"), ("Ada", "Ek", "a@x.org", "DELETE"), ("Bo", "Li", "b@x.org", None)])
    df = payloads(spark, "a@x.org", "b@x.org", "a@x.org b@x.org")
    assert modes(spark, df, asked) == [2, 1, 2]
    scalar = TableRules("s", emails=("email", "email2"), scalars=("email",), columns=("email",))
    two = spark.createDataFrame(
        [(0, "a@x.org", None), (1, None, "b@x.org"), (2, "b@x.org", "a@x.org"), (3, None, None)],
        "id int, email string, email2 string",
    )
    assert modes(spark, two, asked, scalar) == [2, 1, 2, 0]
    counts = {r[0]: r[1] for r in matching.match_counts(two, scalar, matching.subjects_of(asked)).collect()}
    assert counts == {"REQ-0001": 2, "REQ-0002": 2, "REQ-0003": 2}


def test_all_identifiers_rule(spark):
    rules = TableRules(
        "c", emails=("email",), names=(("fn", "first_name"), ("ln", "last_name")), payloads=("doc",), columns=("email",)
    )
    df = spark.createDataFrame(
        [(0, "a@x.org", "Ada", "Ek", "a@x.org Ada Ek"), (1, "a@x.org", "Ada", "Ek", "a@x.org"),
         (2, "a@x.org", "ADA", "Ek", "a@x.org Ada Ek")],
        "id int, email string, fn string, ln string, doc string",
    )
    asked = queue(spark, [("Ada", "Ek", "a@x.org", "DELETE"), ("Bo", "Ek", "a@x.org", "OBFUSCATE")])
    assert modes(spark, df, asked, rules, matching.ALL_IDENTIFIERS) == [2, 0, 0]
    counts = {r[0]: r[1] for r in
              matching.match_counts(df, rules, matching.subjects_of(asked), matching.ALL_IDENTIFIERS).collect()}
    assert counts == {"REQ-0001": 1, "REQ-0002": 0}
    assert modes(spark, df.select("id", "doc"), asked, PAYLOAD_RULES, matching.ALL_IDENTIFIERS) == [2, 0, 2]


def test_case_flag(spark):
    rules = TableRules("s", emails=("email",), scalars=("email",), columns=("email",))
    df = spark.createDataFrame([(0, "A@X.org"), (1, "a@x.org")], "id int, email string")
    asked = queue(spark, [("", "", "a@X.org", "DELETE")])
    flagged = matching.flag_rows(df, rules, matching.subjects_of(asked, True), case_insensitive=True)
    assert [r[matching.MODE] for r in flagged.orderBy("id").collect()] == [2, 2]
    assert modes(spark, df, asked, rules) == [0, 0]


def test_late_requests_stay_open(spark):
    q = queue(spark)
    processed = q.where("request_id <> 'REQ-0004'").select("request_id")
    rows = {r["request_id"]: r for r in erasure.scrub_queue(q, processed).collect()}
    assert rows["REQ-0001"]["email"] == ERASED_TOKEN and rows["REQ-0001"]["status"] == "COMPLETE"
    assert rows["REQ-0004"]["email"] == "fatima.alsayed@example.com" and rows["REQ-0004"]["status"] == "PENDING"


def test_targets(spark):
    assert erasure.parse_targets(" a.b,\nc.d , a.b ", "x.y") == ["a.b", "c.d"]
    assert erasure.parse_targets(" ", "x.y") == ["x.y"]
    for bad in ("a", "a.b.c", ".b", "a."):
        with pytest.raises(ValueError):
            erasure.parse_targets(bad, "x.y")


def test_other_people_with_the_same_name_are_reported_but_can_be_left_out(spark):
    t = {"contact_email_only": spark.createDataFrame([(1, "marta.field@example.com", "Marta", True)],
                                                     "contact_id long, email string, phone string, opt_in boolean"),
         "booking": spark.createDataFrame([(1, "Marta Other", "p", "f", 1)],
                                          "booking_id long, full_name string, pnr string, flight_no string, fare_usd int")}
    reg = testdata.registry(spark).where("table_name in ('contact_email_only', 'booking')")
    target = [erasure.Target("a.b", t, reg, queue(spark, SUBJECTS[:1]))]
    strict = erasure.run_targets(spark, target, dry_run=False)
    assert {(r["table"], r["matched_field"]) for r in strict.findings.collect()} == {("booking", "first")}
    assert strict.verdict.first()["verdict"] == "FAIL"
    loose = erasure.run_targets(spark, target, dry_run=False, verdict_fields=("email", "full"))
    assert loose.verdict.first()["verdict"] == "PASS"


def test_published_tables_hold_no_old_bytes(spark, tmp_path):
    source = tables(spark)
    home = {n: str(tmp_path / n) for n in source}
    for name, df in source.items():
        df.coalesce(2).write.option("compression", "uncompressed").parquet(home[name])
    stored = {n: spark.read.parquet(p) for n, p in home.items()}
    spark.conf.set("spark.sql.parquet.compression.codec", "uncompressed")
    try:
        result = erasure.run_targets(
            spark,
            [erasure.Target("a.b", stored, testdata.registry(spark), queue(spark))],
            dry_run=False,
            publish=lambda target, table, df: replace_table(df, home[table]),
        )
        assert result.verdict.first()["verdict"] == "PASS"
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    assert result.audit.count() == 20
    for name in result.erased["a.b"]:
        assert not (tmp_path / f"{name}__old").exists() and not (tmp_path / f"{name}__new").exists()
        blob = b"".join(f.read_bytes() for f in (tmp_path / name).rglob("*") if f.is_file())
        for _, _, email, _ in SUBJECTS:
            assert email.encode() not in blob
    # a second run finds nothing
    again = erasure.run_targets(
        spark,
        [erasure.Target("a.b", {n: spark.read.parquet(p) for n, p in home.items()}, testdata.registry(spark), queue(spark))],
        dry_run=False,
    )
    assert {r["action"] for r in again.audit.collect()} == {"no_match"}


def test_stored_tables_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(scenarios, "ROWS_PER_FILE", 10)
    table = scenarios.stored(spark, "nowhere", "spread", lambda: spark.range(0, 95, 1, 1).toDF("id"))
    files = [r["count"] for r in table.groupBy("_metadata.file_path").count().collect()]
    assert sum(files) == 95 and max(files) == 10
