import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from palimpsest.functions.masking import ERASED_TOKEN
from palimpsest.operators import erasure, intake, matching, validation
from palimpsest.plans import generators
from palimpsest.sources import landing, rewrite
from palimpsest.streaming import medallion
from palimpsest.streaming.medallion import Lakehouse

FIRST = ["Alva", "Bo", "Cleo", "Dina"]


def record(user, event, hour=0, **more):
    email = f"{FIRST[user % 4].lower()}.test{user}@example.com"
    name = f"{FIRST[user % 4]} Test{user}"
    profile = json.dumps({"contact": {"email": email, "name": name}, "loyalty": {"tier": "gold", "ltv": 1.5}})
    return {
        "event_id": f"U{user:06d}-{event}", "user_id": f"U{user:06d}", "email": email, "full_name": name,
        "profile_json": profile, "revenue": 10.0 + event, "event_ts": f"2026-07-01T{event:02d}:00:00",
        "_ingest_ts": f"2026-07-01T{event + hour:02d}:30:00", **more,
    }


def write(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.writelines(json.dumps(r, separators=(",", ":")) + "\n" for r in records)


def queue(spark, *rows):
    return spark.createDataFrame(
        [(f"REQ-{i:03d}", e, t, "PENDING") for i, (e, t) in enumerate(rows, 1)],
        "request_id string, subject_email string, request_type string, status string",
    )


def email(user):
    return record(user, 0)["email"]


@pytest.fixture
def zone(tmp_path):
    """40 users x 5 events in 8 files, four or five users to a file; user 39 alone in a ninth."""
    for part in range(8):
        write(str(tmp_path / f"landing/initial/part {part}.json"),
              [record(u, e) for u in range(39) if u % 8 == part for e in range(5)])
    write(str(tmp_path / "landing/initial/alone.json"), [record(39, e) for e in range(5)])
    return tmp_path


def counts(house):
    return house.raw().count(), house.bronze().count(), house.silver().count(), house.gold().count()


def test_whole_story(spark, zone):
    house = Lakehouse(spark, str(zone / "landing"), str(zone / "tables"))
    house.run()
    assert counts(house) == (200, 200, 200, 40)

    asked = queue(spark, (email(0).upper(), "DELETE"), (email(9), "OBFUSCATE"), (email(39), "DELETE"),
                  ("ghost@example.com", "DELETE"))
    files = sorted((zone / "landing/initial").glob("*.json"))
    before = {f.name: f.read_bytes() for f in files}
    planned = {r["layer"]: (r["rows"], r["files"]) for r in house.plan(asked).collect()}
    assert planned["landing"] == (15, 3) and planned["gold"] == (3, None)
    assert all(planned[name][0] == 15 and 1 <= planned[name][1] for name in ("raw", "bronze", "silver"))
    assert counts(house) == (200, 200, 200, 40)
    assert {f.name: f.read_bytes() for f in files} == before
    run = house.erase(asked)

    assert run.gold_refreshed
    assert counts(house) == (190, 190, 190, 38)
    assert {r["layer"]: r["rows"] for r in run.counts_before.collect()} == {
        "raw": 15, "bronze": 15, "silver": 15, "gold": 3}
    assert {r["layer"]: r["rows"] for r in run.counts_after().collect()} == {
        "raw": 5, "bronze": 5, "silver": 5, "gold": 1}
    assert run.changed_files["landing"] == {"rewritten": 2, "removed": 1}
    after = {f.name: f.read_bytes() for f in (zone / "landing/initial").glob("*.json")}
    assert set(before) - set(after) == {"alone.json"}
    assert {n for n in after if after[n] != before[n]} == {"part 0.json", "part 1.json"}
    assert all(v == 0 for v in (r["violations"] for r in run.violations().collect()))
    done = run.complete(asked.unionByName(queue(spark, ("late@x.org", "DELETE")).withColumn("request_id", F.lit("REQ-99"))))
    assert {r["request_id"]: r["status"] for r in done.collect()} == {
        "REQ-001": "COMPLETE", "REQ-002": "COMPLETE", "REQ-003": "COMPLETE", "REQ-004": "COMPLETE", "REQ-99": "PENDING",
    }
    scrubbed = run.complete(asked, scrub=True)
    assert {r["subject_email"] for r in scrubbed.collect()} == {ERASED_TOKEN}
    for df in (*house.base_layers().values(), house.files()):
        kept = df.where("user_id = 'U000009'").collect()
        assert len(kept) == 5
        for row in kept:
            assert row["email"] == row["full_name"] == ERASED_TOKEN
            assert json.loads(row["profile_json"]) == {
                "contact": {"email": ERASED_TOKEN, "name": ERASED_TOKEN}, "loyalty": {"tier": "gold", "ltv": 1.5}}
            assert row["revenue"] >= 10

    # the streams neither stop nor read rewritten files again
    house.run()
    assert counts(house) == (190, 190, 190, 38)

    # second wave: new files, new and old subjects
    write(str(zone / "landing/incremental/wave2.json"), [record(u, e) for u in range(900, 908) for e in range(3)])
    house.run()
    assert counts(house) == (214, 214, 214, 46)
    second = house.erase(queue(spark, (email(900), "DELETE"), (email(901), "OBFUSCATE"), (email(1), "DELETE"), (email(2), "OBFUSCATE")))
    assert second.passed()
    assert counts(house) == (206, 206, 206, 44)

    # nothing comes back, whatever is run
    house.full_refresh()
    assert counts(house) == (206, 206, 206, 44)
    house.run()
    assert counts(house) == (206, 206, 206, 44)
    # a request that was handled finds nothing any more
    again = house.erase(queue(spark, (email(0), "DELETE"), (email(9), "OBFUSCATE")))
    assert again.resolved.isEmpty() and again.changed_files["landing"] == {"rewritten": 0, "removed": 0}
    assert not again.gold_refreshed


def test_known_counts(spark, tmp_path):
    """2,000 users with 5 events each, ten alternating requests, then 24 new records and a second wave."""
    zone = str(tmp_path / "landing")
    landing.write_landing(generators.user_events(spark, 2000, 5), f"{zone}/initial", files=8)
    house = Lakehouse(spark, zone, str(tmp_path / "tables"))
    house.run()
    assert counts(house) == (10_000, 10_000, 10_000, 2_000)
    wave = intake.candidate_subjects(house.raw(), queue(spark, ("x", "DELETE")).withColumnRenamed("subject_email", "email"),
                                     10, ERASED_TOKEN)
    asked = generators.request_wave(wave)
    assert house.erase(asked).passed()
    assert counts(house) == (9_975, 9_975, 9_975, 1_995)
    landing.write_landing(generators.user_events(spark, 8, 3, first_id=900_001), f"{zone}/incremental", files=2)
    house.run()
    assert counts(house) == (9_999, 9_999, 9_999, 2_003)
    house.full_refresh()
    assert counts(house) == (9_999, 9_999, 9_999, 2_003)


def test_a_run_that_died_half_way_can_be_repeated(spark, zone, monkeypatch):
    house = Lakehouse(spark, str(zone / "landing"), str(zone / "tables"))
    house.run()
    asked = queue(spark, (email(0), "DELETE"), (email(1), "OBFUSCATE"))
    real = rewrite.erase_layer_files

    def dies_at_bronze(spark, layer, *rest):
        if layer.endswith("bronze"):
            raise OSError("lost")
        return real(spark, layer, *rest)

    monkeypatch.setattr(rewrite, "erase_layer_files", dies_at_bronze)
    with pytest.raises(OSError):
        house.erase(asked)
    monkeypatch.undo()
    assert house.erase(asked).passed()
    assert counts(house) == (195, 195, 195, 39)


def test_without_scrub_a_full_refresh_brings_people_back(spark, zone):
    house = Lakehouse(spark, str(zone / "landing"), str(zone / "tables"))
    house.run()
    run = house.erase(queue(spark, (email(0), "DELETE")), scrub_files=False)
    assert not run.passed()
    with pytest.raises(RuntimeError):
        run.complete(queue(spark, (email(0), "DELETE")))
    house.full_refresh()
    assert counts(house)[0] == 200


def test_obfuscate_leaves_gold_alone(spark, zone):
    house = Lakehouse(spark, str(zone / "landing"), str(zone / "tables"))
    house.run()
    gold = {r["user_id"]: r for r in house.gold().collect()}
    run = house.erase(queue(spark, (email(3), "OBFUSCATE")))
    assert not run.gold_refreshed and run.passed()
    assert {r["user_id"]: r for r in house.gold().collect()} == gold
    row = gold["U000003"]
    assert (row["lifetime_revenue"], row["event_count"], row["last_event_ts"]) == (60.0, 5, "2026-07-01T04:00:00")


def test_latest_only(spark, zone):
    house = Lakehouse(spark, str(zone / "landing"), str(zone / "tables"), latest_only=True)
    house.run()
    assert counts(house) == (200, 200, 40, 40)
    write(str(zone / "landing/incremental/w.json"),
          [record(1, 9), {**record(2, 1), "event_id": "late", "revenue": 999.0}, record(77, 1)])
    house.run()
    rows = {r["user_id"]: r for r in house.silver().collect()}
    assert len(rows) == 41
    assert rows["U000001"]["event_id"] == "U000001-9"
    assert rows["U000002"]["event_id"] == "U000002-4"  # the late, older event is ignored
    stored = lambda: len([p for p in os.listdir(zone / "tables/silver") if p.startswith(("batch_id=", "fold_id="))])
    assert stored() == 2
    house.compact_silver()
    assert stored() == 1
    assert {r["user_id"]: r["event_id"] for r in house.silver().collect()} == {u: r["event_id"] for u, r in rows.items()}
    run = house.erase(queue(spark, (email(1), "DELETE"), (email(2), "OBFUSCATE")))
    assert run.passed() and counts(house)[2:] == (40, 40)
    write(str(zone / "landing/incremental/x.json"), [record(78, 1)])
    house.run()
    assert counts(house)[2:] == (41, 41)
    house.full_refresh()
    assert counts(house)[2:] == (41, 41)
    gold = {r["user_id"]: r["latest_revenue"] for r in house.gold().collect()}
    assert gold["U000003"] == 14.0


def test_silver_drops_rows_without_user(spark):
    df = spark.createDataFrame([record(1, 1), {**record(2, 1), "user_id": None}], landing.LANDING_SCHEMA)
    assert medallion.silver_of(df).count() == 1


def test_scrub_keeps_unknown_fields_and_odd_payloads(spark, tmp_path):
    path = tmp_path / "landing/a/x.json"
    lines = [
        record(1, 1, extra={"email": "keep@me"}, flag=True, nothing=None, big=12345678901234567890),
        record(1, 2, profile_json=7),
        {"user_id": "U000001", "event_id": "bare", "profile_json": '{"name":"A \\"q\\" B"}'},
        record(2, 1),
    ]
    write(str(path), lines)
    original = path.read_text().splitlines()
    modes = spark.createDataFrame([("U000001", 1)], f"user_id string, {matching.MODE} int")
    assert rewrite.scrub_landing(spark, str(tmp_path / "landing"), modes) == {"rewritten": 1, "removed": 0}
    text = path.read_text().splitlines()
    assert original[3] in text
    out = {r["event_id"]: r for r in map(json.loads, text)}
    first = out["U000001-1"]
    assert first["email"] == first["full_name"] == ERASED_TOKEN
    assert first["extra"] == {"email": "keep@me"} and first["flag"] is True
    assert "nothing" in first and first["nothing"] is None and first["big"] == 12345678901234567890
    assert list(first) == list(lines[0])
    assert out["U000001-2"]["profile_json"] == 7
    assert set(out["bare"]) == {"user_id", "event_id", "profile_json"}
    assert out["bare"]["profile_json"].startswith('{"name":"***REDACTED***"')


def test_hot_user_and_layers(spark):
    rows = [record(1, e % 24) for e in range(300)] + [record(u, 1) for u in range(2, 50)]
    df = spark.createDataFrame(rows, landing.LANDING_SCHEMA)
    resolved = matching.resolve_subject_keys(df, queue(spark, (email(1), "OBFUSCATE"), (email(1), "DELETE"), (email(2), "OBFUSCATE")))
    modes = matching.user_modes(resolved)
    erased = erasure.erase_layer(df, modes)
    assert erased.count() == 48
    assert validation.masked_rows({"x": erased}).first()[0] == 1
    assert medallion.latest_per_user(df).count() == 49


def test_replayed_batch_is_not_written_twice(spark, tmp_path):
    batch = spark.createDataFrame([record(1, 1)], landing.LANDING_SCHEMA)
    sink = medallion._write_batch(str(tmp_path / "layer"))
    sink(batch, 3)
    names = sorted(os.listdir(tmp_path / "layer/batch_id=3"))
    sink(batch, 3)
    assert sorted(os.listdir(tmp_path / "layer/batch_id=3")) == names
    os.remove(tmp_path / "layer/batch_id=3/_SUCCESS")
    sink(batch, 3)
    assert spark.read.parquet(str(tmp_path / "layer/batch_id=3")).count() == 1


def test_recover_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rewrite.replace_table(spark.range(3).toDF("a"), path)
    shutil.move(path, path + "__old")
    rewrite.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 3
    rewrite.replace_table(spark.read.parquet(path).where("a > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_files_view_and_counts(spark, zone):
    landing.files_view(spark, str(zone / "landing"), "landing_files")
    assert spark.sql("SELECT count(*) FROM landing_files WHERE user_id = :u", args={"u": "U000001"}).first()[0] == 5
    assert {r["folder"]: r["records"] for r in landing.landing_counts(spark, str(zone / "landing")).collect()} == {
        "initial": 200, "all": 200}
