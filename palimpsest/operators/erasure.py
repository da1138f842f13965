"""Erase subjects from tables, and say what was done.

Every change is a pure function from a table to its erased form: one pass flags
the rows, drops the deleted and overwrites the registered columns of the rest.
Writing is left to a ``publish`` callback (see ``sources.tables``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.masking import (
    ERASED_TOKEN,
    PAYLOAD_ERASURE_POLICY,
    PROFILE_ERASURE_POLICY,
    mask_expr,
)
from palimpsest.operators import matching, validation
from palimpsest.operators.matching import DELETE_CODE, EMAIL_FIRST, MODE, OBFUSCATE_CODE, Matches, Subjects
from palimpsest.operators.registry import TableRules, registry_rows, rules_in_scope, skipped_tables
from palimpsest.session import broadcast_if_small, inline_table

AUDIT_SCHEMA = (
    "target string, request_id string, email string, request_type string, "
    "table string, rows_matched long, action string"
)


def apply_erasure(
    flagged: DataFrame,
    rules: TableRules,
    token: str = ERASED_TOKEN,
    payload_policy: Mapping = PAYLOAD_ERASURE_POLICY,
) -> DataFrame:
    """Drop DELETE rows; overwrite every registered column of OBFUSCATE rows; keep the rest."""
    redact = F.col(MODE) == OBFUSCATE_CODE

    def column(name: str):
        if name in rules.scalars:
            return F.when(redact, F.lit(token)).otherwise(F.col(name)).alias(name)
        if name in rules.masked:
            masked = mask_expr(name, payload_policy, token=token)
            return F.when(redact, masked).otherwise(F.col(name)).alias(name)
        return F.col(name)

    kept = flagged.where(F.col(MODE) != DELETE_CODE)
    return kept.select(*[column(c) for c in flagged.columns if c != MODE])


def erase_table(
    df: DataFrame, rules: TableRules, subjects: Subjects, token: str = ERASED_TOKEN, rule: str = EMAIL_FIRST, **options
) -> DataFrame:
    """The erased table.  ``options`` of ``matching.find``: ``case_insensitive``, ``whole_address``."""
    return apply_erasure(matching.flag_rows(df, rules, subjects, rule, **options), rules, token)


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def find_all(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules], subjects: Subjects, which: tuple[str, ...] = (EMAIL_FIRST,), **options
) -> dict[str, Matches]:
    """One scan of each table in scope: all that audits, erasures and comparisons of rules need."""
    return {name: matching.find(tables[name], rules[name], subjects, which, **options) for name in sorted(rules)}


def audit(
    target: str,
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    subjects: Subjects,
    dry_run: bool = True,
    rule: str = EMAIL_FIRST,
    matches: Mapping[str, Matches] | None = None,
    **options,
) -> DataFrame:
    """Matched rows and action per (request, table in scope)."""
    spark = subjects.frame.sparkSession
    named = {name: r for name, r in rules.items() if r.has_identifiers}
    matches = matches or find_all(tables, named, subjects, (rule,), **options)
    parts = [matches[name].counts(rule).withColumn("table", F.lit(name)) for name in sorted(named)]
    if not parts:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    done = F.lit("dry_run") if dry_run else F.when(F.col("request_type") == "DELETE", "deleted").otherwise("obfuscated")
    return (
        _union(parts)
        .join(subjects.side(subjects.frame.select("request_id", "email", "request_type")), "request_id")
        .select(
            F.lit(target).alias("target"),
            "request_id",
            "email",
            "request_type",
            "table",
            "rows_matched",
            F.when(F.col("rows_matched") > 0, done).otherwise("no_match").alias("action"),
        )
    )


def compare_rules(
    tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules], subjects: Subjects, **options
) -> DataFrame:
    """Rows each matching rule would touch, per (request, table): both rules from one scan of each table."""
    both = (EMAIL_FIRST, matching.ALL_IDENTIFIERS)
    names = ("email_first_rows", "all_match_rows")
    named = {name: r for name, r in rules.items() if r.has_identifiers}
    matches = find_all(tables, named, subjects, both, **options)
    none = F.lit(0).cast("long")
    parts = [
        found.counts(rule).select(
            "request_id", F.lit(table).alias("table"), *[(F.col("rows_matched") if rule == r else none).alias(n) for r, n in zip(both, names, strict=True)]
        )
        for table, found in matches.items()
        for rule in both
    ]
    if not parts:
        return subjects.frame.select("request_id", F.lit("").alias("table"), none.alias(names[0]), none.alias(names[1]), none.alias("row_diff")).limit(0)
    summed = _union(parts).groupBy("request_id", "table").agg(*[F.sum(n).alias(n) for n in names])
    return summed.withColumn("row_diff", F.col(names[0]) - F.col(names[1]))


# --- several targets -------------------------------------------------------------


@dataclass
class Target:
    """One schema: its tables, its registry (None when missing) and its own requests."""

    name: str
    tables: Mapping[str, DataFrame]
    registry: DataFrame | None
    requests: DataFrame | None = None


@dataclass
class RunResult:
    audit: DataFrame
    findings: DataFrame
    summary: DataFrame
    verdict: DataFrame
    erased: dict[str, dict[str, DataFrame]] = field(default_factory=dict)
    skipped: dict[str, DataFrame] = field(default_factory=dict)
    #: ``target, request_id, validation``: what each target was asked for when the run began, written down.
    manifest: DataFrame | None = None


def parse_targets(text: str | None, default: str) -> list[str]:
    """``catalog.schema`` names separated by commas or newlines, each once; blank means the default."""
    names: list[str] = []
    for piece in re.split(r"[,\n]", text or ""):
        if not piece.strip():
            continue
        parts = [p.strip() for p in piece.split(".")]
        if len(parts) != 2 or not all(parts):
            raise ValueError(f"target {piece.strip()!r} is not of the form catalog.schema")
        name = ".".join(parts)
        if name not in names:
            names.append(name)
    return names or [default]


def _open_subjects(requests: DataFrame, case_insensitive: bool = False) -> Subjects:
    return matching.subjects_of(requests.where(F.col("status") == "PENDING"), case_insensitive)


def run_targets(
    spark: SparkSession,
    targets: Iterable[Target],
    scope: str = "customer",
    token: str = ERASED_TOKEN,
    dry_run: bool = True,
    rule: str = EMAIL_FIRST,
    central_requests: DataFrame | None = None,
    verdict_fields: Iterable[str] = validation.NEEDLE_FIELDS,
    publish: Callable[[str, str, DataFrame], DataFrame] | None = None,
    **options,
) -> RunResult:
    """Match, erase and validate every target; evidence comes back as DataFrames.

    Each table is matched in one scan, from which its audit counts and the modes of its
    rows both come.  ``options`` of ``matching.find`` hold for all tables.

    ``publish(target, table, erased)`` writes an erased table and returns what a
    reader now sees; without it the erased frames are validated as they are.
    """
    audits, findings, states, handled = [], [], [], []
    result = RunResult(None, None, None, None)
    # requests that arrive from here on belong to the next run
    asked = [] if central_requests is None else [validation.kept(_open_ids(central_requests))]
    central = None if central_requests is None else _open_subjects(central_requests, options.get("case_insensitive", False))
    for target in targets:
        if target.registry is None:
            states.append((target.name, 0, "skipped_no_registry"))
            continue
        rows = registry_rows(target.registry)
        if not rows:
            states.append((target.name, 0, "skipped_empty_registry"))
            continue
        rules = rules_in_scope(rows, scope)
        result.skipped[target.name] = skipped_tables(target.registry, scope)
        if not rules:
            states.append((target.name, 0, "no_tables_in_scope"))
            continue
        own = None if central is not None else _open_ids(target.requests)
        subjects = central or _open_subjects(target.requests, options.get("case_insensitive", False))
        matches = find_all(target.tables, rules, subjects, (rule,), **options)
        audits.append(audit(target.name, target.tables, rules, subjects, dry_run, rule, matches))
        current = {name: target.tables[name] for name in rules}
        if not dry_run:
            erased = {n: apply_erasure(matches[n].flagged(rule), r, token) for n, r in rules.items()}
            if publish is not None:
                audits[-1] = validation.kept(audits[-1])
                erased = {n: publish(target.name, n, df) for n, df in erased.items()}
            result.erased[target.name] = current = erased
        findings.append(validation.no_trace_scan(target.name, current, rules, subjects))
        states.append((target.name, len(rules), "processed"))
        ids = asked[0] if central is not None else validation.kept(own)
        handled.append(ids.select(F.lit(target.name).alias("target"), "request_id"))

    result.audit = _union(audits) if audits else spark.createDataFrame([], AUDIT_SCHEMA)
    result.findings = (
        _union(findings) if findings else spark.createDataFrame([], validation.FINDINGS_SCHEMA)
    )
    state = inline_table(spark, "target, tables_in_scope, status", states)
    result.summary = summarize(state, result.audit, result.findings, dry_run, verdict_fields)
    result.verdict = verdict(result.summary)
    ids = _union(handled) if handled else spark.createDataFrame([], "target string, request_id string")
    result.manifest = ids.join(result.summary.select("target", "validation"), "target")
    if not dry_run:
        result.manifest = validation.kept(result.manifest)
    return result


def _open_ids(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("status") == "PENDING").select("request_id").distinct()


def close_requests(queue: DataFrame, manifest: DataFrame, target: str | None = None, scrub: bool = False, token: str = ERASED_TOKEN) -> DataFrame:
    """A queue after a run: requests are COMPLETE whose every target passed its validation.

    ``target`` names the owner of a queue of its own; a central queue closes over all
    targets.  Requests that are not in the manifest came later and stay open, and so do
    those of a target that failed or was only tried.  ``scrub`` puts the token for their identifiers.
    """
    mine = manifest if target is None else manifest.where(F.col("target") == target)
    passed = mine.groupBy("request_id").agg(F.bool_and(F.col("validation") == "PASS").alias("ok")).where("ok")
    return scrub_queue(queue, passed, token) if scrub else complete_requests(queue, passed)


def summarize(
    state: DataFrame, audit_rows: DataFrame, findings: DataFrame, dry_run: bool, verdict_fields: Iterable[str]
) -> DataFrame:
    """``target, tables_in_scope, rows_affected, status, validation``."""
    facts = audit_rows.groupBy("target").agg(
        F.sum("rows_matched").alias("rows"), F.lit(0).cast("long").alias("found")
    ).unionByName(
        findings.where(F.col("matched_field").isin(*verdict_fields))
        .groupBy("target")
        .agg(F.lit(0).cast("long").alias("rows"), F.sum("rows").alias("found"))
    )
    totals = facts.groupBy("target").agg(F.sum("rows").alias("rows"), F.sum("found").alias("found"))
    found = F.coalesce("found", F.lit(0)) > 0
    judged = F.lit("dry_run") if dry_run else F.when(found, "FAIL").otherwise("PASS")
    return state.join(totals, "target", "left").select(
        "target",
        "tables_in_scope",
        F.coalesce("rows", F.lit(0)).alias("rows_affected"),
        "status",
        F.when(F.col("status") == "processed", judged).otherwise("n/a").alias("validation"),
    )


def verdict(summary: DataFrame) -> DataFrame:
    """PASS only if every processed target passed."""
    done = F.col("status") == "processed"
    return summary.agg(
        F.count_if(done).alias("processed_targets"),
        F.when(F.count_if(done) == 0, "nothing_processed")
        .when(F.count_if(F.col("validation") == "dry_run") > 0, "dry_run")
        .when(F.count_if(done & (F.col("validation") != "PASS")) == 0, "PASS")
        .otherwise("FAIL")
        .alias("verdict"),
    )


# --- layers keyed by user id --------------------------------------------------------


def flag_by_user(layer: DataFrame, modes: DataFrame) -> DataFrame:
    """A layer with its erase mode; ``modes`` has one row per user id."""
    joined = layer.join(broadcast_if_small(modes), "user_id", "left")
    return joined.select(*layer.columns, F.coalesce(MODE, F.lit(0)).alias(MODE))


def redact_user_row(token: str = ERASED_TOKEN) -> dict:
    """What OBFUSCATE does to a layer row: column -> new value."""
    return {
        "email": F.lit(token),
        "full_name": F.lit(token),
        "profile_json": mask_expr("profile_json", PROFILE_ERASURE_POLICY, token=token),
    }


def erase_layer(layer: DataFrame, modes: DataFrame, token: str = ERASED_TOKEN) -> DataFrame:
    flagged = flag_by_user(layer, modes)
    new = redact_user_row(token)
    redact = F.col(MODE) == OBFUSCATE_CODE
    return flagged.where(F.col(MODE) != DELETE_CODE).select(
        *[F.when(redact, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in layer.columns]
    )


def layer_match_counts(layers: Mapping[str, DataFrame], modes: DataFrame) -> DataFrame:
    """Rows of requested users per layer (zeros included), in one pass over the union of the key columns."""
    hit = broadcast_if_small(modes.select("user_id", F.lit(1).alias("_hit")))
    keys = _union(
        df.select("user_id", F.lit(name).alias("layer")) for name, df in layers.items()
    ).join(hit, "user_id", "left")
    return keys.groupBy("layer").agg(F.count("_hit").alias("rows"))


def needs_gold_refresh(modes: DataFrame) -> bool:
    """Only a DELETE changes a rollup that holds no personal column."""
    return not modes.where(F.col(MODE) == DELETE_CODE).isEmpty()


# --- the queue itself ------------------------------------------------------------------


def scrub_queue(
    queue: DataFrame,
    processed: DataFrame,
    token: str = ERASED_TOKEN,
    columns: Iterable[str] = ("first_name", "last_name", "email"),
) -> DataFrame:
    """Processed requests become COMPLETE and lose their identifiers; requests that came later stay."""
    return _complete(queue, processed, {c: F.lit(token) for c in columns})


def complete_requests(queue: DataFrame, processed: DataFrame) -> DataFrame:
    """Processed requests become COMPLETE, also those that matched nothing."""
    return _complete(queue, processed, {})


def _complete(queue: DataFrame, processed: DataFrame, new: Mapping) -> DataFrame:
    done = broadcast_if_small(processed.select("request_id").distinct().withColumn("_done", F.lit(True)))
    hit = F.col("_done") & (F.col("status") == "PENDING")
    new = {**new, "status": F.lit("COMPLETE")}
    return queue.join(done, "request_id", "left").select(
        *[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in queue.columns]
    )
