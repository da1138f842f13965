import datetime as dt

from pyspark.sql import functions as F

from palimpsest.operators import discovery, overhead

NOW = dt.datetime(2026, 1, 1, 12)


def log(spark, *rows):
    return spark.createDataFrame(
        [(f"s{i}", text, kind, ms, ms + 1, 0, 10, 20, 0.5, NOW - dt.timedelta(hours=ago))
         for i, (text, kind, ms, ago) in enumerate(rows)],
        "statement_id string, statement_text string, statement_type string, execution_ms long, total_ms long, "
        "compilation_ms long, read_rows long, read_bytes long, io_cache_pct double, started_at timestamp",
    )


def test_collect(spark):
    mark = overhead.marker("1m", "dynamic", "point_lookup")
    rows = log(
        spark,
        (mark + " SELECT 1", "SELECT", 5, 1),
        (overhead.marker("10m", "baseline", "full_scan_mask", 3) + " SELECT 1", "SELECT", 5, 6),
        (mark + " SELECT 1", "INSERT", 5, 1),
        ("SELECT 1 " + mark, "SELECT", 5, 1),
        (mark + " SELECT 1", "SELECT", 5, 7),
        (mark + " SELECT 1", "SELECT", 5, 1),
    )
    known = spark.createDataFrame([("s5",)], "statement_id string")
    got = overhead.collect_timings(rows, known, F.lit(NOW)).orderBy("statement_id").collect()
    assert [(r["statement_id"], r["scale"], r["variant"], r["pattern"], r["iter"]) for r in got] == [
        ("s0", "1m", "dynamic", "point_lookup", None),
        ("s1", "10m", "baseline", "full_scan_mask", 3),
    ]
    assert len(got[0]) == 13


def test_summaries(spark):
    rows = [("1m", "p", "baseline", v) for v in (10, 20, 40)] + [("1m", "p", "dynamic", v) for v in (30, 50)]
    rows += [("100m", "p", "baseline", 0), ("100m", "p", "dynamic", 7)]
    df = spark.createDataFrame(
        [(*r, r[3] + 1, 100) for r in rows],
        "scale string, pattern string, variant string, execution_ms long, total_ms long, read_rows long",
    )
    med = overhead.report_order(overhead.summary_median(df)).collect()
    assert [(r["scale"], r["variant"]) for r in med] == [
        ("1m", "baseline"), ("1m", "dynamic"), ("100m", "baseline"), ("100m", "dynamic")]
    assert (med[1]["p50_ms"], med[1]["overhead_ms"], med[1]["overhead_pct"]) == (40, 20, 100.0)
    assert med[3]["overhead_pct"] is None
    best = {(r["scale"], r["variant"]): r for r in overhead.summary_best(df).collect()}
    assert (best["1m", "dynamic"]["exec_ms"], best["1m", "dynamic"]["overhead_pct"]) == (30, 200.0)
    assert best["1m", "dynamic"]["scale_sortable"] == "1_1m"
    assert overhead.chart_rows(overhead.summary_best(df), scale="1m", variant="dynamic").count() == 1


def test_discovery(spark):
    docs = [
        '{"c":{"email":"ada@x.org","phone":"+1 555 010 020"},"t":"GOLD","n":1}',
        '{"c":{"email":"bo@x.org"},"t":"GOLD","tags":["a","b"],"l":[{"who":"Ada Ek"}]}',
        '{"c":{"email":"none"}}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    profile = discovery.path_profile(df, "doc")
    rows = {r["path"]: r for r in profile.collect()}
    assert set(rows) == {"$.c.email", "$.c.phone", "$.t", "$.n", "$.tags[]", "$.l[].who"}
    assert (rows["$.c.email"]["values"], rows["$.c.email"]["email_hits"]) == (3, 2)
    assert (rows["$.t"]["values"], rows["$.t"]["distinct_values"]) == (2, 1)
    found = {r["path"]: (r["pii_type"], r["score"]) for r in discovery.propose_paths(profile).collect()}
    assert found == {"$.c.email": ("email", 0.6667), "$.c.phone": ("phone", 1.0), "$.l[].who": ("person_name", 1.0)}


def test_discovery_of_mixed_shapes(spark):
    docs = ['{"a":"x","Email":"1"}', '{"a":{"b":"me@x.com"},"email":"2"}', '"alone@x.org"', "7", None, "{broken", '{"e":{},"l":[],"n":null}',
            '{"q":"a \\" { [ b","l":[[1],[{"k":true}]]}', "[]", '{"id9":1}']
    df = spark.createDataFrame([(d, "p") for d in docs], "doc string, path string")
    rows = {r["path"]: (r["values"], r["email_hits"]) for r in discovery.path_profile(df, "doc").collect()}
    assert rows == {
        "$.a": (1, 0), "$.Email": (1, 0), "$.a.b": (1, 1), "$.email": (1, 0), "$": (3, 1), "$.q": (1, 0),
        "$.l[][]": (1, 0), "$.l[][].k": (1, 0), "$.id9": (1, 0),
    }
    assert discovery.path_profile(df.limit(0), "doc").count() == 0
