"""The file index, byte-preserving redaction, folds that die half way, bounded hops."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import json_spans
from palimpsest.operators import matching
from palimpsest.operators.matching import MODE
from palimpsest.operators.registry import TableRules
from palimpsest.sources import landing, paths, rewrite
from palimpsest.sources.file_index import bloom, may_hold
from palimpsest.streaming import medallion
from palimpsest.streaming.medallion import RAW_SCHEMA, Lakehouse
from test_streaming import email, queue, record, write


def test_filters_miss_nothing_and_name_little_in_vain():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 1000):
        keys = rng.integers(-(1 << 63), (1 << 63) - 1, n)
        bits = bloom(keys)
        assert all(may_hold(bits, keys[k : k + 1]) for k in range(n))
        strange = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
        assert sum(may_hold(bits, strange[k : k + 1]) for k in range(3000)) < 60


def test_index_against_brute_force(spark, tmp_path):
    layer, rng = str(tmp_path / "layer"), random.Random(4)
    rows = [record(rng.randrange(400), e % 20) for e in range(2000)]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    df.withColumn("part", F.pmod(F.hash("user_id"), F.lit(40))).repartition("part").write.partitionBy("part").parquet(layer)
    index = rewrite.layer_index(spark, str(tmp_path / "index"), layer, RAW_SCHEMA)
    users = spark.createDataFrame([(f"U{u:06d}",) for u in (1, 2, 3, 9999)], "user_id string")
    everything = index.files().count()
    assert index.candidates("user_id", users).count() == everything  # what is not indexed may hold anybody
    assert index.refresh() == everything and index.refresh() == 0
    full = index.read([layer]).select("user_id", "email", F.col("_metadata.file_path").alias("_file"))
    holding = {r[0] for r in full.join(users, "user_id").select("_file").distinct().collect()}
    named = [r[0] for r in index.candidates("user_id", users).collect()]
    assert len(named) == len(set(named)) and holding <= set(named) and len(named) <= len(holding) + 2
    assert index.rows(index.candidates("user_id", users)).join(users, "user_id").count() == full.join(users, "user_id").count()
    mails = spark.createDataFrame([(email(1),), (None,)], "email string")
    assert {r[0] for r in full.where(F.col("email") == email(1)).select("_file").distinct().collect()} <= {
        r[0] for r in index.candidates("email", mails).collect()}
    assert index.candidates("user_id", users.limit(0)).count() == 0
    spark.createDataFrame([record(9999, 1)], RAW_SCHEMA).coalesce(1).write.parquet(layer + "/late")
    assert len({r[0] for r in index.candidates("user_id", users).collect()} - set(named)) == 1
    assert index.refresh() == 1


def test_an_erasure_opens_few_files(spark, tmp_path):
    for part in range(6):
        write(str(tmp_path / f"landing/a/part {part}.json"), [record(u, e) for u in range(part * 5, part * 5 + 5) for e in range(2)])
    house = Lakehouse(spark, str(tmp_path / "landing"), str(tmp_path / "tables"), files_per_batch=1)
    house.run()
    run = house.erase(queue(spark, (email(7), "DELETE"), (email(28), "OBFUSCATE")))
    assert run.passed() and run.changed_files["landing"] == {"rewritten": 2, "removed": 0}
    assert 2 <= run.opened_files["landing"] <= 4
    assert all(0 < n < 6 for n in run.opened_files.values())
    # one landing file per batch, and one file of the layer before per batch of the next
    raw = [p for p in os.listdir(tmp_path / "tables/raw") if p.startswith("batch_id=")]
    bronze = [p for p in os.listdir(tmp_path / "tables/bronze") if p.startswith("batch_id=")]
    files = sum(len([f for f in os.listdir(tmp_path / "tables/raw" / p) if f.endswith(".parquet")]) for p in raw)
    assert len(raw) == 6 and len(bronze) == files


LINES = [
    '{"user_id":"U1","email":"a@x.org","n":1.50,"big":123456789012345678901234567890,"e":1E+2}',
    ' { "user_id" : "U1" ,\t"email":\t"a@x.org" , "email":"b@x.org","full_name":null}',
    '{"\\u0065mail":"a\\u0040x.org","user_id":"U1","email\\u0000":"keep","nested":{"email":"keep@x"}}',
    '{"user_id":"U1","profile_json":"{\\"email\\" : \\"a@x.org\\",\\"t\\":\\"\\\\u00e9\\u00e9\\\\\\\\\\",\\"name\\":\\"\\ud83d\\ude00 A\\"}","x":"\\/"}',
    '{"user_id":"U1","profile_json":{"email":"inner@x"},"email":7}\r',
    '{"user_id":"U1","profile_json":"no json \\"name\\":\\"A\\" \\"email\\":\\"\\" end"}',
]
WANTED = [
    '{"user_id":"U1","email":"#","n":1.50,"big":123456789012345678901234567890,"e":1E+2}',
    ' { "user_id" : "U1" ,\t"email":\t"#" , "email":"#","full_name":"#"}',
    '{"\\u0065mail":"#","user_id":"U1","email\\u0000":"keep","nested":{"email":"keep@x"}}',
    '{"user_id":"U1","profile_json":"{\\"email\\" : \\"#\\",\\"t\\":\\"\\\\u00e9\\u00e9\\\\\\\\\\",\\"name\\":\\"#\\"}","x":"\\/"}',
    '{"user_id":"U1","profile_json":{"email":"inner@x"},"email":"#"}\r',
    '{"user_id":"U1","profile_json":"no json \\"name\\":\\"#\\" \\"email\\":\\"#\\" end"}',
]


@pytest.mark.parametrize("k", range(len(LINES)))
def test_redaction_changes_only_the_values(k):
    assert json_spans.redacted(LINES[k], ("email", "full_name"), "profile_json", ("email", "name"), "#") == WANTED[k]


def test_spans_of_random_records():
    rng = random.Random(6)

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        if kind == 6:
            return {rng.choice("abé\"\\"): value(depth - 1) for _ in range(rng.randrange(3))}
        return [None, True, -1.5e3, "x\"\\y\n😀", 12][kind]

    for _ in range(200):
        doc = {rng.choice(["email", "a", "é", "b\"c", "😀"]): value(3) for _ in range(rng.randrange(5))}
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        spans = json_spans.members(text)
        assert [(k, json.loads(text[a:b])) for k, a, b in spans] == list(doc.items())
        for _, a, b in spans:
            if text[a] == '"':
                shown, spelled = json_spans.characters(text[a:b])
                assert shown == json.loads(text[a:b]) and len(shown) == len(spelled) and "".join(spelled) == text[a + 1 : b - 1]
    for bad in ("[1]", "{", '{"a" 1}', '{"a":1,}', '{"a":}', "", '{"a":1 "b":2}'):
        with pytest.raises(ValueError):
            json_spans.members(bad)


def test_scrubbed_files_differ_in_nothing_else(spark, tmp_path):
    other = ['{"user_id":"U2", "email":"o@x.org","n":0.10}', '{"user_id":"U3"}\r']
    file = tmp_path / "landing/x.json"
    file.parent.mkdir()
    file.write_bytes(("\n".join([other[0], *LINES, other[1]]) + "\n").encode())
    modes = spark.createDataFrame([("U1", 1)], f"user_id string, {MODE} int")
    assert rewrite.scrub_landing(spark, str(tmp_path / "landing"), modes, "#") == {"rewritten": 1, "removed": 0}
    assert sorted(file.read_bytes().decode().split("\n")) == sorted([other[0], *WANTED, other[1], ""])


def latest(house):
    return {r["user_id"]: r["event_id"] for r in house.silver().collect()}


@pytest.mark.parametrize("dies_at", ["write", "move", "delete"])
def test_a_fold_that_dies_neither_loses_nor_doubles(spark, tmp_path, monkeypatch, dies_at):
    house = Lakehouse(spark, str(tmp_path / "landing"), str(tmp_path / "tables"), latest_only=True)
    for wave in range(2):
        write(str(tmp_path / f"landing/w{wave}.json"), [record(u, wave + 1) for u in range(wave, 12)])
        house.run()
    before = latest(house)
    assert len(before) == 12

    def dies(*_):
        raise OSError("lost")

    real = paths.delete
    if dies_at == "write":
        monkeypatch.setattr(medallion, "latest_per_user", lambda df: dies())
    elif dies_at == "move":
        monkeypatch.setattr(paths, "move", dies)
    else:
        monkeypatch.setattr(paths, "delete", lambda spark, path: dies() if "batch_id" in path else real(spark, path))
    with pytest.raises(OSError):
        house.compact_silver()
    monkeypatch.undo()
    assert latest(house) == before
    write(str(tmp_path / "landing/w9.json"), [record(1, 9), record(50, 1)])
    house.run()
    assert latest(house) == {**before, "U000001": "U000001-9", "U000050": "U000050-1"}
    assert house.compact_silver() >= 1 and house.compact_silver() == 0
    assert latest(house) == {**before, "U000001": "U000001-9", "U000050": "U000050-1"}
    assert sum(len(p) for p in house._folds().values()) <= 2
    run = house.erase(queue(spark, (email(1), "DELETE")))
    assert run.passed() and "U000001" not in latest(house)


def test_many_batches_are_folded_by_the_run(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(medallion, "FOLD_AT", 2)
    house = Lakehouse(spark, str(tmp_path / "landing"), str(tmp_path / "tables"), latest_only=True)
    for wave in range(4):
        write(str(tmp_path / f"landing/w{wave}.json"), [record(u, wave + 1) for u in range(wave, 6)])
        house.run()
        assert all(len(p) < 2 for p in house._folds().values())
    assert len(latest(house)) == 6


def test_nothing_left_of_a_table_is_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "people")
    people = spark.createDataFrame([(k, f"p{k}@x.org") for k in range(6)], "id long, email string")
    people.repartition(3).write.parquet(path)
    asked = people.selectExpr("cast(id as string) as request_id", "'' as first_name", "'' as last_name", "email", "'DELETE' as request_type")
    rules = TableRules("people", emails=("email",), masked=(), columns=("email",))
    for files in (3, 0):
        done = rewrite.erase_files(spark, path, rules, matching.subjects_of(asked), schema=people.schema)
        assert done == {"files": files, "rewritten": 0, "removed": files}
        left = rewrite.layer_rows(spark, people.schema, path)
        assert left.columns == ["id", "email"] and left.isEmpty()


def test_files_of_a_layer_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "ROWS_PER_FILE", 5)
    rows = [record(u, 1) for u in range(40)]
    write(str(tmp_path / "all.json"), rows)
    zone = str(tmp_path / "landing")
    landing.write_landing(landing.read_landing(spark, str(tmp_path / "all.json")), zone, files=2)
    house = Lakehouse(spark, zone, str(tmp_path / "tables"))
    house.run()
    for df in (house.files(), *house.base_layers().values()):
        sizes = [r["count"] for r in df.groupBy("_metadata.file_path").count().collect()]
        assert sum(sizes) == 40 and max(sizes) <= 5
    run = house.erase(queue(spark, (email(1), "DELETE"), (email(2), "OBFUSCATE")))
    assert run.passed() and run.changed_files["landing"]["rewritten"] >= 1
    assert house.files().count() == 39
