"""Every query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import json_spans
from palimpsest.functions.masking import (
    DEFAULT_POLICIES,
    ERASED_TOKEN,
    NULLIFY,
    PARTIAL,
    PROFILE_ERASURE_POLICY,
    REDACT,
    hash_json_field,
    mask_expr,
    mask_variant,
    masked_field,
    register_mask_functions,
)
from palimpsest.operators import (
    discovery,
    erasure,
    intake,
    matching,
    overhead,
    policy_views,
    registry,
    validation,
)
from palimpsest.plans import scenarios, testdata
from palimpsest.session import written
from palimpsest.sources import landing
from palimpsest.streaming import medallion

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- masking ---------------------------------------------------------------------------

HIT_POLICY = DEFAULT_POLICIES["name"]
USER_POLICY = DEFAULT_POLICIES["email"]

# Patterns valid in Java and RE2 alike.
DOCUMENT_PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    r"[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}",
    r"\+?[0-9]{1,3}[ -][0-9]{2,4}[ -][0-9]{3,4}[ -]?[0-9]{2,4}",
    r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    r'token = "[^"]*"',
]


def _masked_both(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    return scenarios.hits(spark, sf_dir).select(
        "hit_id",
        mask_expr("hit_payload", {**HIT_POLICY, "strategy": strategy}).alias("hit_payload"),
        mask_expr("user_payload", {**USER_POLICY, "strategy": strategy}).alias("user_payload"),
    )


@query
def mask_redact(spark, sf_dir):
    return _masked_both(spark, sf_dir, REDACT)


@query
def mask_nullify(spark, sf_dir):
    return _masked_both(spark, sf_dir, NULLIFY)


@query
def mask_partial(spark, sf_dir):
    return _masked_both(spark, sf_dir, PARTIAL)


@query
def mask_url_params(spark, sf_dir):
    policy = {"url_params": ["page", "ref", "utm_source"]}
    return testdata.table(spark, sf_dir, "pages").select("page_id", mask_expr("url", policy).alias("url"))


@query
def mask_url_params_nullify(spark, sf_dir):
    policy = {"url_params": ["page", "ref", "utm_source"], "strategy": NULLIFY}
    return testdata.table(spark, sf_dir, "pages").select("page_id", mask_expr("url", policy).alias("url"))


@query
def mask_regex_documents(spark, sf_dir):
    documents = testdata.table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.select("doc_id", mask_expr("text", {"regex": DOCUMENT_PATTERNS}).alias("text"))


@query
def mask_regex_nullify_conversations(spark, sf_dir):
    policy = {"regex": DOCUMENT_PATTERNS[:1], "strategy": NULLIFY}
    return testdata.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", mask_expr("text", policy).alias("text")
    )


@query
def mask_pages_html(spark, sf_dir):
    policy = {"regex": DOCUMENT_PATTERNS[:1], "strategy": PARTIAL}
    return testdata.table(spark, sf_dir, "pages").select("page_id", mask_expr("html", policy).alias("html"))


@query
def mask_policy_dynamic(spark, sf_dir):
    return policy_views.apply_policies(scenarios.hits(spark, sf_dir), testdata.HIT_TAGS, DEFAULT_POLICIES)


@query
def mask_policy_exempt(spark, sf_dir):
    return policy_views.apply_policies(
        scenarios.hits(spark, sf_dir),
        testdata.HIT_TAGS,
        DEFAULT_POLICIES,
        principal_groups=["analysts", "privacy_office"],
        exempt_groups=["privacy_office"],
    )


@query
def mask_sql_function(spark, sf_dir):
    register_mask_functions(spark, DEFAULT_POLICIES)
    scenarios.hits(spark, sf_dir).createOrReplaceTempView("hits_for_sql_masks")
    return spark.sql(
        "SELECT hit_id, mask_pii_name(hit_payload) AS hit_payload, "
        "mask_pii_email(user_payload) AS user_payload FROM hits_for_sql_masks"
    )


@query
def mask_materialized(spark, sf_dir):
    return scenarios.hits_variants(spark, sf_dir)["materialized"]


@query
def mask_hash_batch(spark, sf_dir):
    schema = "contact struct<email: string, phone: string>, loyalty struct<tier: string, points: int>"
    hashed = hash_json_field("user_payload", schema, ["contact", "email"])
    return scenarios.hits(spark, sf_dir).select("hit_id", hashed.alias("user_payload"))


@query
def mask_variant_fields(spark, sf_dir):
    masked = mask_variant(F.try_parse_json("user_payload"), USER_POLICY)
    return scenarios.hits(spark, sf_dir).select("hit_id", masked.alias("v")).select(
        "hit_id",
        F.try_variant_get("v", "$.contact.email", "string").alias("email"),
        F.try_variant_get("v", "$.contact.phone", "string").alias("phone"),
        F.try_variant_get("v", "$.loyalty.points", "bigint").alias("points"),
    )


@query
def mask_before_after(spark, sf_dir):
    def both(column, path, policy):
        return F.get_json_object(column, path), F.get_json_object(mask_expr(column, policy), path)

    fields = {
        "name": both("hit_payload", "$.appInfo.name", HIT_POLICY),
        "url": both("hit_payload", "$.documentLocation", HIT_POLICY),
        "email": both("user_payload", "$.contact.email", USER_POLICY),
        "phone": both("user_payload", "$.contact.phone", USER_POLICY),
    }
    return policy_views.before_after(scenarios.hits(spark, sf_dir), fields, "hit_id")


@query
def mask_full_document(spark, sf_dir):
    fields = {
        "hit": (F.col("hit_payload"), mask_expr("hit_payload", HIT_POLICY)),
        "user": (F.col("user_payload"), mask_expr("user_payload", USER_POLICY)),
    }
    return policy_views.before_after(scenarios.hits(spark, sf_dir), fields, "hit_id", rows=1)


@query
def mask_validation_counts(spark, sf_dir):
    return validation.masking_counts(scenarios.hits_variants(spark, sf_dir)["dynamic"], testdata.APP_NAME)


@query
def mask_structure_diff(spark, sf_dir):
    hits = scenarios.hits(spark, sf_dir)
    both = hits.select("hit_payload", mask_expr("hit_payload", HIT_POLICY).alias("masked"))
    return validation.structure_changes(both, "hit_payload", "masked")


@query
def mask_structure_diff_mixed(spark, sf_dir):
    """The same over documents without a common schema, with a mask of one key."""
    docs = testdata.mixed_documents(spark, sf_dir)
    return validation.structure_changes(docs.withColumn("masked", mask_expr("doc", {"keys": ["b"]})), "doc", "masked")


@query
def json_path_profile_mixed(spark, sf_dir):
    return discovery.path_profile(testdata.mixed_documents(spark, sf_dir), "doc")


@query
def json_path_profile(spark, sf_dir):
    return discovery.path_profile(scenarios.hits(spark, sf_dir), "hit_payload")


@query
def json_path_profile_events(spark, sf_dir):
    return discovery.path_profile(testdata.table(spark, sf_dir, "events"), "props")


@query
def json_path_proposals(spark, sf_dir):
    return discovery.propose_paths(discovery.path_profile(scenarios.hits(spark, sf_dir), "user_payload"))


# --- tags and registry ----------------------------------------------------------------------


@query
def tag_inventory(spark, sf_dir):
    return policy_views.tag_inventory(testdata.catalog_tags(spark, sf_dir)["column_tags"])


@query
def tag_missing_values(spark, sf_dir):
    tags = testdata.catalog_tags(spark, sf_dir)["column_tags"]
    needed = policy_views.required_tag_values(tags, ["name", "email", "ssn"])
    allowed = tags.where("tag_name = 'pii' and tag_value like '%e%'").select("tag_value").distinct()
    return policy_views.missing_tag_values(needed, allowed)


def _registry(spark, sf_dir) -> DataFrame:
    return registry.build_registry(**testdata.catalog_tags(spark, sf_dir))


@query
def registry_merged_tags(spark, sf_dir):
    return registry.merged_tags(testdata.catalog_tags(spark, sf_dir)["column_tags"])


@query
def registry_seed(spark, sf_dir):
    return _registry(spark, sf_dir)


@query
def registry_scope(spark, sf_dir):
    return registry.in_scope(_registry(spark, sf_dir), "customer")


@query
def registry_skipped(spark, sf_dir):
    return registry.skipped_tables(_registry(spark, sf_dir), "customer")


@query
def registry_purge_tables(spark, sf_dir):
    return registry.tables_to_purge(_registry(spark, sf_dir), "employee")


# --- intake -------------------------------------------------------------------------------------


def _mapped(spark, sf_dir) -> DataFrame:
    return intake.map_requests(intake.parse_documents(testdata.request_documents(spark, sf_dir)))


@query
def intake_map(spark, sf_dir):
    return _mapped(spark, sf_dir)


@query
def intake_actionable(spark, sf_dir):
    return intake.actionable(_mapped(spark, sf_dir))


@query
def intake_dropped(spark, sf_dir):
    return intake.actionable_counts(_mapped(spark, sf_dir))


@query
def intake_upsert(spark, sf_dir):
    today = F.lit("2026-07-30").cast("date")
    return intake.upsert_requests(
        scenarios.request_queue(spark, sf_dir), intake.actionable(_mapped(spark, sf_dir)), today=today
    )


@query
def intake_status(spark, sf_dir):
    return intake.queue_by_status(scenarios.request_queue(spark, sf_dir))


@query
def intake_status_type(spark, sf_dir):
    return intake.queue_by_status(scenarios.request_queue(spark, sf_dir), "request_type")


@query
def intake_pending(spark, sf_dir):
    return intake.pending(scenarios.request_queue(spark, sf_dir))


@query
def intake_number_requests(spark, sf_dir):
    who = testdata.person(spark, sf_dir).select("email")
    return intake.number_requests(who)


@query
def intake_next_number(spark, sf_dir):
    return intake.next_request_number(scenarios.request_queue(spark, sf_dir))


@query
def intake_candidates(spark, sf_dir):
    return intake.candidate_subjects(
        scenarios.raw_events(spark, sf_dir), scenarios.request_queue(spark, sf_dir), 10, ERASED_TOKEN
    )


# --- matching and erasure ---------------------------------------------------------------------------


def _subjects(spark, sf_dir) -> matching.Subjects:
    return matching.subjects_of(scenarios.request_queue(spark, sf_dir).where("status = 'PENDING'"))


def _rules(spark, scope="customer"):
    return scenarios.rules(spark, scope)


def _audit(spark, sf_dir, **options) -> DataFrame:
    return erasure.audit(
        "crm.people", scenarios.erasure_tables(spark, sf_dir), _rules(spark), _subjects(spark, sf_dir), **options
    )


@query
def match_email_first(spark, sf_dir):
    return _audit(spark, sf_dir).select("request_id", "table", "rows_matched")


@query
def match_all_identifiers(spark, sf_dir):
    return _audit(spark, sf_dir, rule=matching.ALL_IDENTIFIERS).select("request_id", "table", "rows_matched")


@query
def match_rule_diff(spark, sf_dir):
    return erasure.compare_rules(
        scenarios.erasure_tables(spark, sf_dir), _rules(spark), _subjects(spark, sf_dir)
    )


@query
def match_payload_orders(spark, sf_dir):
    """Email-in-payload matching on the larger hit table."""
    rules = registry.TableRules("hits", payloads=("hit_payload", "user_payload"))
    return matching.match_counts(scenarios.hits(spark, sf_dir), rules, _subjects(spark, sf_dir))


@query
def erase_audit(spark, sf_dir):
    return _audit(spark, sf_dir, dry_run=False)


@query
def erase_dry_run(spark, sf_dir):
    return _audit(spark, sf_dir, dry_run=True)


def _erased(spark, sf_dir, table, rule=matching.EMAIL_FIRST) -> DataFrame:
    rules = _rules(spark, "all")[table]
    return erasure.erase_table(
        scenarios.erasure_tables(spark, sf_dir)[table], rules, _subjects(spark, sf_dir), rule=rule
    )


@query
def erase_customer_profile(spark, sf_dir):
    return _erased(spark, sf_dir, "customer_profile")


@query
def erase_contact(spark, sf_dir):
    return _erased(spark, sf_dir, "contact_email_only")


@query
def erase_booking(spark, sf_dir):
    return _erased(spark, sf_dir, "booking")


@query
def erase_loyalty(spark, sf_dir):
    return _erased(spark, sf_dir, "loyalty_split")


@query
def erase_hits(spark, sf_dir):
    return _erased(spark, sf_dir, "app_hits_json")


@query
def erase_profile_all_match(spark, sf_dir):
    return _erased(spark, sf_dir, "customer_profile", matching.ALL_IDENTIFIERS)


@query
def erase_hits_all_match(spark, sf_dir):
    return _erased(spark, sf_dir, "app_hits_json", matching.ALL_IDENTIFIERS)


@query
def erase_hits_in_place(spark, sf_dir):
    """The payload table after its files were erased in place."""
    return scenarios.hits_in_place(spark, sf_dir).table


@query
def erase_in_place_files(spark, sf_dir):
    """How many files there were, were rewritten, and were removed because nothing was left."""
    done = scenarios.hits_in_place(spark, sf_dir).files
    return spark.createDataFrame([tuple(done[k] for k in ("files", "rewritten", "removed"))], "files long, rewritten long, removed long")


@query
def match_whole_address(spark, sf_dir):
    """Addresses in notes, only where they are no part of a longer one."""
    found = matching.match_counts(scenarios.notes(spark, sf_dir), scenarios.NOTE_RULES, _subjects(spark, sf_dir), whole_address=True)
    return found


@query
def match_part_of_address(spark, sf_dir):
    """The same by plain containment: also inside longer addresses."""
    return matching.match_counts(scenarios.notes(spark, sf_dir), scenarios.NOTE_RULES, _subjects(spark, sf_dir))


@query
def erase_whole_address(spark, sf_dir):
    """Rows of notes that an erasure by whole addresses drops or redacts."""
    flagged = matching.flag_rows(scenarios.notes(spark, sf_dir), scenarios.NOTE_RULES, _subjects(spark, sf_dir), whole_address=True)
    return flagged.where(F.col(matching.MODE) > 0).select("note_id", F.col(matching.MODE).alias("erase_mode"))


def _run(spark, sf_dir, dry_run=False) -> erasure.RunResult:
    tables, reg = scenarios.erasure_tables(spark, sf_dir), testdata.registry(spark)
    queue = scenarios.request_queue(spark, sf_dir)
    crm = reg.where(F.col("table_name").isin("customer_profile", "contact_email_only"))
    ops = reg.where(F.col("table_name").isin("booking", "loyalty_split", "app_hits_json", "employee_crew"))
    staff = reg.where(F.col("table_name") == "employee_crew")
    targets = [
        erasure.Target("crm.people", tables, crm),
        erasure.Target("ops.travel", tables, ops),
        erasure.Target("hr.staff", tables, staff),
        erasure.Target("lab.blank", tables, reg.limit(0)),
        erasure.Target("lab.absent", tables, None),
    ]
    return erasure.run_targets(
        spark,
        targets,
        dry_run=dry_run,
        central_requests=queue,
        publish=lambda target, table, erased: written(erased, f"published-{table}"),
    )


@query
def erase_multi_target_audit(spark, sf_dir):
    return _run(spark, sf_dir).audit


@query
def erase_multi_target_summary(spark, sf_dir):
    return _run(spark, sf_dir).summary


@query
def erase_multi_target_dry_run(spark, sf_dir):
    return _run(spark, sf_dir, dry_run=True).summary


@query
def erase_by_name_summary(spark, sf_dir):
    """Targets resolved from their names, published, and judged by the addresses that are left."""
    return scenarios.named_run(spark, sf_dir).result.summary


@query
def erase_by_name_manifest(spark, sf_dir):
    return scenarios.named_run(spark, sf_dir).result.manifest


@query
def queue_closed_by_manifest(spark, sf_dir):
    """The central queue afterwards: handled requests complete, those that came meanwhile open."""
    return scenarios.named_run(spark, sf_dir).queue.select("request_id", "status")


@query
def erase_verdict(spark, sf_dir):
    return _run(spark, sf_dir).verdict


@query
def queue_scrub_complete(spark, sf_dir):
    return erasure.scrub_queue(scenarios.request_queue(spark, sf_dir), _subjects(spark, sf_dir).frame)


@query
def queue_complete_by_id(spark, sf_dir):
    queue = scenarios.request_queue(spark, sf_dir)
    return erasure.complete_requests(queue, queue.where("status = 'PENDING' and request_type = 'DELETE'"))


@query
def no_trace_scan_before(spark, sf_dir):
    return validation.no_trace_scan(
        "crm.people", scenarios.erasure_tables(spark, sf_dir), _rules(spark), _subjects(spark, sf_dir)
    )


@query
def no_trace_scan_after(spark, sf_dir):
    return _run(spark, sf_dir).findings


@query
def neighbours_untouched(spark, sf_dir):
    """Changed or vanished rows that no request matched: there must be none."""
    rules = _rules(spark)["customer_profile"]
    before = scenarios.erasure_tables(spark, sf_dir)["customer_profile"]
    flagged = matching.flag_rows(before, rules, _subjects(spark, sf_dir))
    after = erasure.apply_erasure(flagged, rules)
    hit = flagged.where(F.col(matching.MODE) > 0).select("customer_id", F.lit(1).alias("_hit"))
    return (
        validation.row_changes(before, after)
        .join(hit, "customer_id", "left")
        .agg(
            F.coalesce(F.sum(F.when(F.col("copies") < 0, -F.col("copies"))), F.lit(0)).alias("rows_gone"),
            F.coalesce(F.sum(F.when(F.col("copies") > 0, F.col("copies"))), F.lit(0)).alias("rows_new"),
            F.count_if(F.col("_hit").isNull()).alias("neighbours_changed"),
        )
    )


@query
def purge_no_bytes(spark, sf_dir):
    return scenarios.purge_evidence(spark, sf_dir)


# --- layers keyed by user ---------------------------------------------------------------------------


def _layers(spark, sf_dir) -> dict[str, DataFrame]:
    raw = scenarios.raw_events(spark, sf_dir).drop("event_type")
    bronze = medallion.bronze_of(raw)
    return {"raw": raw, "bronze": bronze, "silver": medallion.silver_of(bronze).drop("_silver_ts")}


def _resolved(spark, sf_dir) -> DataFrame:
    return matching.resolve_subject_keys(
        scenarios.raw_events(spark, sf_dir), scenarios.layer_requests(spark, sf_dir)
    )


def _modes(spark, sf_dir) -> DataFrame:
    return matching.user_modes(_resolved(spark, sf_dir))


def _erased_layers(spark, sf_dir) -> dict[str, DataFrame]:
    modes = _modes(spark, sf_dir)
    return {n: erasure.erase_layer(df, modes) for n, df in _layers(spark, sf_dir).items()}


@query
def resolve_subject_keys(spark, sf_dir):
    return _resolved(spark, sf_dir)


@query
def resolve_user_modes(spark, sf_dir):
    return _modes(spark, sf_dir).withColumnRenamed(matching.MODE, "erase_mode")


@query
def erase_layer_raw(spark, sf_dir):
    return _erased_layers(spark, sf_dir)["raw"]


@query
def erase_layer_silver(spark, sf_dir):
    return _erased_layers(spark, sf_dir)["silver"]


@query
def erase_layer_counts(spark, sf_dir):
    return erasure.layer_match_counts(_layers(spark, sf_dir), _modes(spark, sf_dir))


@query
def no_trace_matrix(spark, sf_dir):
    layers = {**_layers(spark, sf_dir), "file": _erased_layers(spark, sf_dir)["raw"]}
    return validation.cleartext_matrix(scenarios.layer_requests(spark, sf_dir), layers)


@query
def delete_proof(spark, sf_dir):
    layers = _erased_layers(spark, sf_dir)
    return validation.erasure_proof(scenarios.layer_requests(spark, sf_dir), layers, "DELETE")


@query
def obfuscate_proof(spark, sf_dir):
    layers = {"raw": _erased_layers(spark, sf_dir)["raw"], "untouched": _layers(spark, sf_dir)["bronze"]}
    return validation.erasure_proof(scenarios.layer_requests(spark, sf_dir), layers, "OBFUSCATE", "cleartext")


@query
def masked_row_counts(spark, sf_dir):
    return validation.masked_rows(_erased_layers(spark, sf_dir))


@query
def masked_row_sample(spark, sf_dir):
    return validation.masked_sample(_erased_layers(spark, sf_dir)["raw"])


@query
def requested_cleartext(spark, sf_dir):
    return validation.requested_cleartext(
        scenarios.layer_requests(spark, sf_dir), _layers(spark, sf_dir)["silver"]
    )


@query
def erase_invariants(spark, sf_dir):
    """The delete and obfuscate checks, over erased layers and (as a control) an untouched one."""
    layers = {**_erased_layers(spark, sf_dir), "control": _layers(spark, sf_dir)["raw"]}
    resolved = _resolved(spark, sf_dir)
    return validation.delete_violations(resolved, layers).unionByName(
        validation.obfuscate_violations(resolved, layers)
    )


@query
def layer_counts(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    return validation.layer_counts({**layers, "gold": medallion.gold_lifetime(layers["silver"])})


@query
def queue_snapshot(spark, sf_dir):
    layers = _layers(spark, sf_dir)
    return validation.queue_snapshot(
        layers["raw"], medallion.gold_lifetime(layers["silver"]), scenarios.request_queue(spark, sf_dir)
    )


@query
def gold_refresh(spark, sf_dir):
    """Gold over silver after the erasure."""
    gold = medallion.gold_lifetime(_erased_layers(spark, sf_dir)["silver"])
    return gold.withColumn("lifetime_revenue", F.round("lifetime_revenue", 2))


@query
def indexed_rows(spark, sf_dir):
    """Rows of the users to delete, read from the files the index names and from no other."""
    layer = scenarios.indexed_layer(spark, sf_dir)
    rows = layer.index.rows(layer.index.candidates("user_id", layer.users))
    return rows.join(layer.users, "user_id", "left_semi").select("event_id", "user_id")


@query
def indexed_files(spark, sf_dir):
    """Files of the layer, files that hold a user to delete, and how many of those the index does not name."""
    layer = scenarios.indexed_layer(spark, sf_dir)
    rows = layer.index.read([layer.index.folder])
    holding = rows.select("user_id", F.col("_metadata.file_path").alias("_file")).join(layer.users, "user_id", "left_semi").select("_file").distinct()
    named = layer.index.candidates("user_id", layer.users).withColumn("named", F.lit(1))
    held = holding.join(named, "_file", "left").agg(F.count(F.lit(1)).alias("holding"), F.count_if(F.col("named").isNull()).alias("missed"))
    return layer.index.files().agg(F.count(F.lit(1)).alias("files")).join(held)


@query
def redact_lines_in_place(spark, sf_dir):
    """Landing lines with the values of two users in three redacted, and nothing else changed."""
    lines = testdata.event_lines(spark, sf_dir)
    mine = F.when(F.col("user_id") % 3 > 0, F.col("line"))
    redacted = json_spans.redact_lines(mine, ("email", "full_name"), "profile_json", PROFILE_ERASURE_POLICY["keys"], ERASED_TOKEN)
    return lines.withColumn("_new", redacted).select("event_id", F.coalesce("_new", "line").alias("line"))


# --- streams -------------------------------------------------------------------------------------------


@query
def stream_raw(spark, sf_dir):
    return scenarios.story(spark, sf_dir).house.raw()


@query
def stream_bronze(spark, sf_dir):
    return scenarios.story(spark, sf_dir).house.bronze()


@query
def stream_silver(spark, sf_dir):
    return scenarios.story(spark, sf_dir).house.silver().drop("_silver_ts")


@query
def stream_after_erasure(spark, sf_dir):
    return scenarios.story(spark, sf_dir).after_erasure["bronze"]


@query
def stream_full_refresh(spark, sf_dir):
    return scenarios.refreshed(spark, sf_dir)


@query
def stream_scd1(spark, sf_dir):
    return scenarios.story(spark, sf_dir, latest_only=True).house.silver()


@query
def gold_append(spark, sf_dir):
    gold = scenarios.story(spark, sf_dir).house.gold()
    return gold.withColumn("lifetime_revenue", F.round("lifetime_revenue", 2))


@query
def gold_scd1(spark, sf_dir):
    gold = scenarios.story(spark, sf_dir, latest_only=True).house.gold()
    return gold.withColumn("latest_revenue", F.round("latest_revenue", 2))


@query
def scrub_files(spark, sf_dir):
    return scenarios.story(spark, sf_dir).house.files()


@query
def landing_counts(spark, sf_dir):
    return landing.landing_counts(spark, scenarios.story(spark, sf_dir).house.landing)


@query
def landing_counts_first(spark, sf_dir):
    return scenarios.story(spark, sf_dir).landed_first


@query
def latest_per_user(spark, sf_dir):
    """The batch twin of the latest-only silver."""
    return medallion.latest_per_user(_layers(spark, sf_dir)["bronze"])


# --- masking overhead patterns -------------------------------------------------------------------------

LOOKUP_ID = 4242


def full_scan_mask(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("c"),
        F.sum(F.length("hit_payload")).alias("s1"),
        F.sum(F.length("user_payload")).alias("s2"),
    )


def point_lookup(df: DataFrame) -> DataFrame:
    return df.where(F.col("hit_id") == LOOKUP_ID).select("hit_payload", "user_payload")


def filter_nonpii(df: DataFrame) -> DataFrame:
    app = F.get_json_object("hit_payload", "$.appInfo.appName")
    return df.where(app == testdata.APP_NAME).agg(F.count(F.lit(1)).alias("c"))


def groupby_nonpii(df: DataFrame) -> DataFrame:
    tier = F.get_json_object("user_payload", "$.loyalty.tier")
    return df.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "tier")


def extract_pii(df: DataFrame) -> DataFrame:
    """A thousand rows; ordered by id so that the same thousand come back every time."""
    name = F.get_json_object("hit_payload", "$.appInfo.name")
    wanted = df.select("hit_id").orderBy("hit_id").limit(1000)
    return df.join(F.broadcast(wanted), "hit_id", "left_semi").select(name.alias("name"))


def no_masked_col(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("c"), F.min("hit_id").alias("lo"), F.max("hit_id").alias("hi")
    )


PATTERNS = (full_scan_mask, point_lookup, filter_nonpii, groupby_nonpii, extract_pii, no_masked_col)
VARIANTS = ("baseline", "dynamic", "materialized")


def _bench(pattern, variant) -> Query:
    return lambda spark, sf_dir: pattern(scenarios.hits_variants(spark, sf_dir)[variant])


for _pattern in PATTERNS:
    for _variant in VARIANTS:
        QUERIES[f"bench_{_pattern.__name__}_{_variant}"] = _bench(_pattern, _variant)


@query
def bench_filter_nonpii_field_first(spark, sf_dir):
    """The dynamic filter through ``masked_field``: same answer, no document is masked."""
    app = masked_field("hit_payload", "$.appInfo.appName", HIT_POLICY)
    baseline = scenarios.hits_variants(spark, sf_dir)["baseline"]
    return baseline.where(app == testdata.APP_NAME).agg(F.count(F.lit(1)).alias("c"))


@query
def bench_groupby_nonpii_field_first(spark, sf_dir):
    tier = masked_field("user_payload", "$.loyalty.tier", USER_POLICY)
    baseline = scenarios.hits_variants(spark, sf_dir)["baseline"]
    return baseline.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "tier")


@query
def bench_warmup(spark, sf_dir):
    variants = scenarios.hits_variants(spark, sf_dir)
    return full_scan_mask(variants["baseline"]).unionAll(full_scan_mask(variants["dynamic"]))


# --- timings -----------------------------------------------------------------------------------------------


def _timings(spark, sf_dir) -> DataFrame:
    log = testdata.query_log(spark, sf_dir)
    known = log.where("statement_id like '%7'").select("statement_id")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return overhead.collect_timings(log, known, now, hours=6 * 24)


@query
def perf_collect(spark, sf_dir):
    return _timings(spark, sf_dir)


@query
def perf_summary_median(spark, sf_dir):
    return overhead.report_order(overhead.summary_median(_timings(spark, sf_dir)))


@query
def perf_summary_best(spark, sf_dir):
    return overhead.summary_best(_timings(spark, sf_dir))


@query
def perf_chart_rows(spark, sf_dir):
    best = overhead.summary_best(_timings(spark, sf_dir))
    return overhead.chart_rows(best, scale="100m", variant="dynamic")


# --- derived tables ------------------------------------------------------------------------------------------


@query
def gen_hits(spark, sf_dir):
    return testdata.hits(spark, sf_dir)


@query
def gen_user_events(spark, sf_dir):
    return testdata.raw_events(spark, sf_dir)


@query
def gen_persons(spark, sf_dir):
    return testdata.person(spark, sf_dir)
