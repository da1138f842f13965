import datetime as dt

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import intake, registry
from palimpsest.plans import testdata


def test_registry_of_the_six_tables(spark):
    rows = {(r["table_name"], r["column_name"]): r for r in testdata.registry(spark).collect()}
    assert len(rows) == 15
    get = lambda t, c: tuple(rows[t, c])[2:]
    assert get("customer_profile", "first_name") == ("first_name", True, "scalar_token", None, "customer")
    assert get("customer_profile", "street_address") == ("none", False, "scalar_token", None, "customer")
    assert get("booking", "pnr") == ("none", False, "pnr_token", None, "customer")
    assert get("app_hits_json", "hit_payload") == ("email", True, "json_key", "name", "customer")
    assert get("employee_crew", "first_name") == ("full_name", True, "scalar_token", None, "employee")


def test_manual_tag_wins(spark):
    tags = spark.createDataFrame(
        [("t", "c", "class.email_address", ""), ("t", "c", "pii", "pnr"), ("t", "d", "class.us_ssn", ""),
         ("t", "e", "class.unknown", ""), ("t", "f", "unrelated", "x")],
        "table_name string, column_name string, tag_name string, tag_value string",
    )
    rows = {r["column_name"]: (r["pii_type"], r["source"]) for r in registry.merged_tags(tags).collect()}
    assert rows == {"c": ("pnr", "manual"), "d": ("other", "classification")}


def test_scope(spark):
    reg = testdata.registry(spark)
    assert "employee_crew" not in registry.rules_by_table(reg)
    assert list(registry.rules_by_table(reg, "employee")) == ["employee_crew"]
    assert len(registry.rules_by_table(reg, "all")) == 6
    assert [r[0] for r in registry.skipped_tables(reg).collect()] == ["employee_crew"]
    with pytest.raises(ValueError):
        registry.in_scope(reg, "vendor")


DOCS = [
    '{"requestQueueRefId":"R1","firstName":"Ada","lastName":"Ek","email":"a@x.org","requestType":"erasure","createdDate":"2026-07-20"}',
    '{"requestQueueRefId":"","id":"R2","first_name":"James","last_name":"O\'Brien","type":"DO_NOT_SELL"}',
    '{"requestId":"R3","emailAddress":"c@x.org","requestType":"whatever","submittedDate":"2026-07-22"}',
    '{"requestId":"R4","firstName":"Solo"}',
    '{"email":"noid@x.org"}',
]


def mapped(spark):
    lines = spark.createDataFrame([(d,) for d in DOCS], "value string")
    return intake.map_requests(intake.parse_documents(lines))


def test_mapping_and_actionable(spark):
    rows = {r["request_id"]: r for r in mapped(spark).collect()}
    assert rows["R1"]["request_type"] == "DELETE"
    assert (rows["R2"]["last_name"], rows["R2"]["request_type"]) == ("O'Brien", "OBFUSCATE")
    assert rows["R3"]["email"] == "c@x.org" and rows["R3"]["first_name"] == ""
    kept = sorted(r["request_id"] for r in intake.actionable(mapped(spark)).collect())
    assert kept == ["R1", "R2", "R3"]
    assert tuple(intake.actionable_counts(mapped(spark)).first()) == (3, 2)


def test_upsert(spark):
    queue = spark.createDataFrame(
        [("R1", "old", "old", "old@x.org", "OBFUSCATE", dt.date(2026, 1, 1), dt.date(2026, 2, 15), "PENDING"),
         ("R2", "***", "***", "***", "DELETE", dt.date(2026, 1, 1), dt.date(2026, 2, 15), "COMPLETE"),
         ("R9", "keep", "keep", "k@x.org", "DELETE", dt.date(2026, 1, 1), dt.date(2026, 2, 15), "PENDING")],
        "request_id string, first_name string, last_name string, email string, request_type string, "
        "request_date date, deadline_date date, status string",
    )
    today = F.lit("2026-08-01").cast("date")
    rows = {r["request_id"]: r for r in intake.upsert_requests(queue, intake.actionable(mapped(spark)), today=today).collect()}
    assert sorted(rows) == ["R1", "R2", "R3", "R9"]
    assert (rows["R1"]["email"], rows["R1"]["deadline_date"]) == ("a@x.org", dt.date(2026, 9, 3))
    assert rows["R2"]["first_name"] == "***" and rows["R2"]["status"] == "COMPLETE"
    assert rows["R3"]["status"] == "PENDING"
    assert rows["R9"]["email"] == "k@x.org"
    no_date = spark.createDataFrame([("R7", "a", "b", "c@d", "DELETE", None)],
                                    "request_id string, first_name string, last_name string, email string, "
                                    "request_type string, request_date string")
    got = {r["request_id"]: r for r in intake.upsert_requests(queue, no_date, today=today).collect()}
    assert got["R7"]["request_date"] == dt.date(2026, 8, 1) and got["R7"]["deadline_date"] == dt.date(2026, 9, 15)


def test_numbers(spark):
    emails = spark.createDataFrame([(f"u{i:03d}@x",) for i in range(100)], "email string")
    rows = intake.number_requests(emails.repartition(7)).orderBy("email").collect()
    assert [r["request_id"] for r in rows] == [f"REQ-{i:04d}" for i in range(1, 101)]
    ids = spark.createDataFrame([("REQ-007",), ("REQ-x",), ("odd",), ("REQ-012",)], "request_id string")
    assert intake.next_request_number(ids).first()[0] == 13


def test_candidates(spark):
    people = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), ("***REDACTED***",), (None,)], "email string")
    queue = spark.createDataFrame([("a",)], "email string")
    rows = intake.candidate_subjects(people, queue, 2, "***REDACTED***").orderBy("position").collect()
    assert [(r["email"], r["request_type"]) for r in rows] == [("b", "DELETE"), ("c", "OBFUSCATE")]
