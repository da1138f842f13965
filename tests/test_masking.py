import json

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import masking as m
from palimpsest.operators import policy_views, validation

NAME, EMAIL = m.DEFAULT_POLICIES["name"], m.DEFAULT_POLICIES["email"]


def masked(spark, text, policy, **options):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(m.mask_expr("t", policy, **options).alias("r")).first()["r"]


@pytest.mark.parametrize("prefilter", [True, False])
@pytest.mark.parametrize(
    "text, redact, nullify, partial",
    [
        ('{"name":"Ada Ek"}', '{"name":"***MASKED***"}', '{"name":null}', '{"name":"A***"}'),
        ('{"name" : "Ada"}', '{"name" : "***MASKED***"}', '{"name" : null}', '{"name" : "A***"}'),
        ('{"name":""}', '{"name":"***MASKED***"}', '{"name":null}', '{"name":""}'),
        ('{"name":"A"}', '{"name":"***MASKED***"}', '{"name":null}', '{"name":"A***"}'),
        ('{"name":5}', '{"name":5}', '{"name":5}', '{"name":5}'),
        ('{"name":null}', '{"name":null}', '{"name":null}', '{"name":null}'),
        ('{"name":{"x":"y"}}', '{"name":{"x":"y"}}', '{"name":{"x":"y"}}', '{"name":{"x":"y"}}'),
        ('{"Name":"Ada"}', '{"Name":"Ada"}', '{"Name":"Ada"}', '{"Name":"Ada"}'),
        ('{"appName":"x"}', '{"appName":"x"}', '{"appName":"x"}', '{"appName":"x"}'),
        ('{"name"\t:"Ada"}', '{"name"\t:"Ada"}', '{"name"\t:"Ada"}', '{"name"\t:"Ada"}'),
        (
            '[{"name":"a"},{"o":{"name":"b"}}]',
            '[{"name":"***MASKED***"},{"o":{"name":"***MASKED***"}}]',
            '[{"name":null},{"o":{"name":null}}]',
            '[{"name":"a***"},{"o":{"name":"b***"}}]',
        ),
        (None, None, None, None),
    ],
)
def test_key_rules(spark, text, redact, nullify, partial, prefilter):
    for strategy, wanted in ((m.REDACT, redact), (m.NULLIFY, nullify), (m.PARTIAL, partial)):
        policy = {"keys": ["name"], "strategy": strategy.lower()}
        assert masked(spark, text, policy, prefilter=prefilter) == wanted


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("https://x/?email=a@b.c&pnr=1", "https://x/?email=***MASKED***&pnr=1"),
        ("https://x/?a=1&email=a b#frag", "https://x/?a=1&email=***MASKED***#frag"),
        ("https://x/?xemail=a@b.c", "https://x/?xemail=a@b.c"),
        ("https://x/?a=1&amp;email=a@b.c", "https://x/?a=1&amp;email=a@b.c"),
        ('{"u":"?email=a@b.c","v":1}', '{"u":"?email=***MASKED***","v":1}'),
        ("https://x/?email=", "https://x/?email=***MASKED***"),
    ],
)
def test_url_rules(spark, text, wanted):
    assert masked(spark, text, {"url_params": ["email"]}) == wanted
    assert masked(spark, text, {"url_params": ["email"], "strategy": "PARTIAL"}) == wanted.replace("***MASKED***", "***")
    assert masked(spark, text, {"url_params": ["email"], "strategy": "NULLIFY"}) == wanted.replace("***MASKED***", "")


def test_free_patterns(spark):
    text = "a ssn=12-3 b ssn=9"
    assert masked(spark, text, {"regex": ["ssn=[0-9-]+"]}) == "a ***MASKED*** b ***MASKED***"
    assert masked(spark, text, {"regex": ["ssn=[0-9-]+"], "strategy": "NULLIFY"}) == "a  b "
    assert masked(spark, text, {"regex": ["ssn=[0-9-]+"], "strategy": "PARTIAL"}) == "a *** b ***"


def test_order_and_structure(spark):
    doc = {
        "appInfo": {"name": "Ada Ek", "appName": "skyward", "tags": [1, None, True]},
        "documentLocation": "https://x/manage?firstName=Ada&lastName=Ek&email=ada.ek@example.com&pnr=AB12CD",
    }
    out = json.loads(masked(spark, json.dumps(doc), NAME))
    doc["appInfo"]["name"] = m.MASK_TOKEN
    doc["documentLocation"] = (
        "https://x/manage?firstName=***MASKED***&lastName=***MASKED***&email=***MASKED***&pnr=AB12CD"
    )
    assert out == doc


def test_escaped_quotes(spark):
    text = '{"name":"A \\"q\\" B","k":1}'
    with pytest.raises(json.JSONDecodeError):
        json.loads(masked(spark, text, NAME))
    safe = masked(spark, text, NAME, escape_aware=True)
    assert json.loads(safe) == {"name": m.MASK_TOKEN, "k": 1}
    assert json.loads(masked(spark, text, {**NAME, "strategy": "PARTIAL"}, escape_aware=True))["name"] == "A***"


def test_keys_and_tokens_are_literals(spark):
    assert masked(spark, '{"a.b":"x","aXb":"y"}', {"keys": ["a.b"]}) == '{"a.b":"***MASKED***","aXb":"y"}'
    assert masked(spark, '{"name":"x"}', NAME, token="$1\\") == '{"name":"$1\\"}'


def test_policy_file_and_ignored_paths(spark, tmp_path):
    path = tmp_path / "policies.json"
    path.write_text(json.dumps({"email": {"keys": ["email"], "paths": ["$.never.read"]}}))
    policy = m.load_policies(str(path))["email"]
    assert m.strategy_of(policy) == m.REDACT
    assert masked(spark, '{"never":{"read":"x"},"email":"e"}', policy) == '{"never":{"read":"x"},"email":"***MASKED***"}'


def test_sql_functions_agree(spark):
    m.register_mask_functions(spark, m.DEFAULT_POLICIES)
    text = '{"name":"O\'Brien","u":"?email=x&lname=y#z"}'
    spark.createDataFrame([(text,)], "t string").createOrReplaceTempView("sql_mask_input")
    got = spark.sql("SELECT mask_pii_name(t) AS r FROM sql_mask_input").first()["r"]
    assert got == masked(spark, text, NAME)


FIELD_DOCS = [
    '{"appInfo":{"appName":"skyward","name":"Ada"},"url":"?email=a&x=1"}',
    '{"appInfo":{"appName":"q?email=z","name":"Ada"}}',
    '{"appInfo":{"appName":"say \\"hi\\"","name":"A \\"q\\" B"}}',
    '{"appInfo":{"appName":{"name":"deep"},"name":"Ada"}}',
    '{"appInfo":{"appName":["x"],"name":"Ada"}}',
    '{"appInfo":{"name":"Ada"}}',
    '{"appInfo":{"appName":null}}',
    '{"appInfo":{"appName":""}}',
    '{"appInfo":{"appName":12}}',
    "not json",
    None,
]


@pytest.mark.parametrize("path", ["$.appInfo.appName", "$.appInfo.name", "$.url", "$.appInfo", "$"])
@pytest.mark.parametrize("strategy", ["REDACT", "NULLIFY", "PARTIAL"])
def test_masked_field_equals_mask_then_extract(spark, path, strategy):
    policy = {**NAME, "strategy": strategy}
    df = spark.createDataFrame([(d,) for d in FIELD_DOCS], "t string")
    rows = df.select(
        m.masked_field("t", path, policy).alias("fast"),
        F.get_json_object(m.mask_expr("t", policy), path).alias("plain"),
    ).collect()
    assert [r["fast"] for r in rows] == [r["plain"] for r in rows]


def test_variant_and_hash(spark):
    df = spark.createDataFrame([('{"contact":{"email":"e@x.org","phone":"1"}}',)], "t string")
    v = df.select(m.mask_variant(F.parse_json("t"), EMAIL).alias("v")).select(F.to_json("v").alias("r")).first()["r"]
    assert json.loads(v) == {"contact": {"email": m.MASK_TOKEN, "phone": "1"}}
    seen = policy_views.apply_policies(df.select(F.parse_json("t").alias("v")), {"v": "email"}, m.DEFAULT_POLICIES)
    assert seen.schema["v"].dataType.simpleString() == "variant"
    assert json.loads(seen.select(F.to_json("v").alias("r")).first()["r"])["contact"]["email"] == m.MASK_TOKEN
    h = df.select(m.hash_json_field("t", "contact struct<email:string,phone:string>", ["contact", "email"]).alias("r"))
    out = json.loads(h.first()["r"])
    assert out["contact"]["phone"] == "1" and len(out["contact"]["email"]) == 64


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unread_mask_costs_nothing_and_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(F.col("id").alias("hit_id"), F.lit('{"name":"x"}').alias("hit_payload")).write.parquet(path)
    df = policy_views.apply_policies(spark.read.parquet(path), {"hit_payload": "name"}, m.DEFAULT_POLICIES)
    assert "regexp_replace" not in plan_of(df.agg(F.max("hit_id")))
    plan = plan_of(df.where("hit_id = 3"))
    assert "EqualTo(hit_id,3)" in plan and "regexp_replace" in plan


def test_policies_by_tag(spark):
    tags = spark.createDataFrame(
        [("t", "p", "pii", "name"), ("t", "q", "other", "name"), ("u", "q", "pii", "email")],
        "table_name string, column_name string, tag_name string, tag_value string",
    )
    found = policy_views.tags_of_table(tags, "t")
    assert found == {"p": "name"}
    df = spark.createDataFrame([('{"name":"x"}', '{"name":"x"}')], "p string, q string")
    row = policy_views.apply_policies(df, found, m.DEFAULT_POLICIES).first()
    assert row["p"] == '{"name":"***MASKED***"}' and row["q"] == '{"name":"x"}'
    raw = policy_views.apply_policies(df, found, m.DEFAULT_POLICIES, ["admins"], {"admins"})
    assert raw.first()["p"] == '{"name":"x"}'
    with pytest.raises(ValueError):
        policy_views.apply_policies(df, {"p": "ssn"}, m.DEFAULT_POLICIES)


def test_structure_changes_only_at_named_paths(spark):
    docs = [
        '{"a":{"name":"x","k":[1,2]},"u":"?email=e","z":null}',
        '{"a":{"name":"","k":[]},"u":"plain","b":[{"name":"n"},{"q":true}]}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "t string").withColumn("m", m.mask_expr("t", NAME))
    rows = {r["path"]: (r["docs"], r["changed_docs"], r["lost_docs"]) for r in
            validation.structure_changes(df, "t", "m").collect()}
    assert rows == {
        "$.a.name": (2, 2, 0), "$.a.k[]": (1, 0, 0), "$.u": (2, 1, 0),
        "$.b[].name": (1, 1, 0), "$.b[].q": (1, 0, 0),
    }
