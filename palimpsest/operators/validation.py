"""Evidence: nothing left of a subject, nobody else touched, structure intact."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import json_leaves
from palimpsest.functions.masking import ERASED_TOKEN, MASK_TOKEN
from palimpsest.operators import needles
from palimpsest.operators.matching import Subjects
from palimpsest.operators.registry import TableRules
from palimpsest.session import broadcast_if_small, written

NEEDLE_FIELDS = ("email", "first", "last", "full")
FINDINGS_SCHEMA = (
    "target string, request_id string, table string, column string, matched_field string, rows long"
)


def kept(df: DataFrame) -> DataFrame:
    """Evidence that must survive the change it describes."""
    return written(df, "evidence")


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- no trace --------------------------------------------------------------------


def subject_needles(subjects: Subjects, fields: Iterable[str] = NEEDLE_FIELDS) -> DataFrame:
    """``request_id, matched_field, needle`` for every identifier a request has."""
    parts = F.array(*[F.struct(F.lit(f).alias("matched_field"), F.col(f).alias("needle")) for f in fields])
    return (
        subjects.frame.select("request_id", F.explode(parts).alias("p"))
        .select("request_id", "p.matched_field", "p.needle")
        .where(F.trim("needle") != "")
    )


def no_trace_scan(
    target: str,
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    subjects: Subjects,
    fields: Iterable[str] = NEEDLE_FIELDS,
) -> DataFrame:
    """Rows of each registered column that still contain an identifier of a processed subject.

    All columns of all tables are searched for all distinct identifiers in one
    narrow pass; counts are spread back to the requests only afterwards.
    """
    spark = subjects.frame.sparkSession
    fields = tuple(fields)
    wanted = subject_needles(subjects, fields)
    stacks = []
    for name in sorted(rules):
        columns = [c for c in rules[name].columns if c in tables[name].columns]
        if not columns:
            continue
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"))
                for c in columns
            ]
        )
        numbered = tables[name].select(F.monotonically_increasing_id().alias("_id"), cells.alias("cells"))
        stacks.append(numbered.select(F.lit(name).alias("table"), "_id", F.explode("cells").alias("cell")).select("table", "_id", "cell.*"))
    if not stacks:
        return spark.createDataFrame([], FINDINGS_SCHEMA)
    prepared = subjects.once(("trace", fields), lambda: needles.prepare(wanted.select("needle").distinct()))
    hits = (
        needles.occurrences(_union(stacks), ["table", "column", "_id"], ["text"], prepared)
        .groupBy("table", "column", "needle")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return hits.join(wanted, "needle").select(
        F.lit(target).alias("target"), "request_id", "table", "column", "matched_field", "rows"
    )


# --- requests x layers ---------------------------------------------------------------


def _cleartext_hits(layers: Mapping[str, DataFrame], emails: DataFrame) -> DataFrame:
    """``layer, email, n`` over all layers for the given emails."""
    stacked = _union(
        df.select(F.lit(name).alias("layer"), F.lower("email").alias("email")) for name, df in layers.items()
    )
    return (
        stacked.join(broadcast_if_small(emails.distinct()), "email")
        .groupBy("email", "layer")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _subject_emails(requests: DataFrame) -> DataFrame:
    return requests.select(F.lower("subject_email").alias("email")).where("email is not null")


def cleartext_matrix(requests: DataFrame, layers: Mapping[str, DataFrame]) -> DataFrame:
    """Per request, the rows of each layer that still carry its email in clear."""
    hits = _cleartext_hits(layers, _subject_emails(requests))
    wide = hits.groupBy("email").agg(
        *[F.sum(F.when(F.col("layer") == n, F.col("n"))).alias(f"{n}_clear") for n in layers]
    )
    return (
        requests.withColumn("email", F.lower("subject_email"))
        .join(wide, "email", "left")
        .select(
            "request_id",
            "request_type",
            "status",
            *[F.coalesce(f"{n}_clear", F.lit(0)).alias(f"{n}_clear") for n in layers],
        )
    )


def erasure_proof(
    requests: DataFrame, layers: Mapping[str, DataFrame], request_type: str, suffix: str = "rows"
) -> DataFrame:
    """One row: per layer, rows that still hold the email of any request of this type (all must be 0)."""
    hits = _cleartext_hits(layers, _subject_emails(requests.where(F.col("request_type") == request_type)))
    return hits.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("layer") == n, F.col("n"))), F.lit(0)).alias(f"{n}_{suffix}")
            for n in layers
        ]
    )


def masked_rows(layers: Mapping[str, DataFrame], token: str = ERASED_TOKEN) -> DataFrame:
    """One row: redacted rows per layer."""
    stacked = _union(df.select(F.lit(n).alias("layer"), "email") for n, df in layers.items())
    hit = F.col("email") == token
    return stacked.agg(*[F.count_if(hit & (F.col("layer") == n)).alias(f"{n}_masked_rows") for n in layers])


def masked_sample(layer: DataFrame, rows: int = 10, token: str = ERASED_TOKEN) -> DataFrame:
    """A few redacted rows, in a fixed order."""
    return layer.where(F.col("email") == token).orderBy("event_id").limit(rows)


def requested_cleartext(requests: DataFrame, layer: DataFrame) -> DataFrame:
    emails = broadcast_if_small(_subject_emails(requests).distinct())
    return (
        layer.select(F.lower("email").alias("email"))
        .join(emails, "email", "left_semi")
        .agg(F.count(F.lit(1)).alias("requested_cleartext_rows"))
    )


# --- counts ------------------------------------------------------------------------------


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        for n, df in layers.items()
    ).orderBy("table")


def queue_snapshot(raw: DataFrame, gold: DataFrame, queue: DataFrame) -> DataFrame:
    """One row: raw rows, gold customers, pending and complete requests."""
    stacked = _union(
        [
            raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit("raw_rows").alias("what"), "n"),
            gold.agg(F.count(F.lit(1)).alias("n")).select(F.lit("gold_customers").alias("what"), "n"),
            queue.groupBy("status").agg(F.count(F.lit(1)).alias("n")).select(
                F.concat(F.lit("requests_"), F.lower("status")).alias("what"), "n"
            ),
        ]
    )
    names = ("raw_rows", "gold_customers", "requests_pending", "requests_complete")
    return stacked.agg(
        *[F.coalesce(F.sum(F.when(F.col("what") == n, F.col("n"))), F.lit(0)).alias(n) for n in names]
    )


# --- invariants after an erasure -----------------------------------------------------------


def delete_violations(resolved: DataFrame, layers: Mapping[str, DataFrame]) -> DataFrame:
    """``check, layer, violations``: rows of DELETE subjects, by user id and by email."""
    gone = resolved.where(F.col("request_type") == "DELETE")
    users = broadcast_if_small(gone.select("user_id").distinct().withColumn("_u", F.lit(1)))
    emails = broadcast_if_small(gone.select("email").distinct().withColumn("_e", F.lit(1)))
    stacked = _union(
        df.select(F.lit(n).alias("layer"), "user_id", F.lower("email").alias("email")) for n, df in layers.items()
    )
    flagged = stacked.join(users, "user_id", "left").join(emails, "email", "left")
    counts = flagged.groupBy("layer").agg(F.count("_u").alias("user_rows"), F.count("_e").alias("email_rows"))
    return counts.select(
        "layer",
        F.explode(
            F.array(
                F.struct(F.lit("delete_user_gone").alias("check"), F.col("user_rows").alias("violations")),
                F.struct(F.lit("delete_email_gone").alias("check"), F.col("email_rows").alias("violations")),
            )
        ).alias("c"),
    ).select("c.check", "layer", "c.violations")


def obfuscate_violations(
    resolved: DataFrame, layers: Mapping[str, DataFrame], token: str = ERASED_TOKEN
) -> DataFrame:
    """``check, layer, violations`` for OBFUSCATE subjects.

    No row keeps the email; every row of the user has the token in its cells
    (a null cell passes); the original email and names are gone from the
    payloads of the user's rows.
    """
    todo = resolved.where(F.col("request_type") == "OBFUSCATE")
    users = broadcast_if_small(
        todo.groupBy("user_id").agg(
            F.collect_set("email").alias("_emails"), F.collect_set("full_name").alias("_names")
        )
    )
    emails = broadcast_if_small(todo.select("email").distinct().withColumn("_e", F.lit(1)))
    stacked = _union(
        df.select(F.lit(n).alias("layer"), "user_id", "email", "full_name", "profile_json")
        for n, df in layers.items()
    )
    flagged = stacked.join(users, "user_id", "left").join(
        emails.withColumnRenamed("email", "_email"), F.lower("email") == F.col("_email"), "left"
    )
    mine = F.col("_emails").isNotNull()
    raw_cell = (F.col("email") != token) | (F.col("full_name") != token)

    def inside(values: str) -> Column:
        return F.exists(F.col(values), lambda v: F.contains(F.col("profile_json"), v))

    counts = flagged.groupBy("layer").agg(
        F.count("_e").alias("email"),
        F.count_if(mine & raw_cell).alias("cells"),
        F.count_if(mine & (inside("_emails") | inside("_names"))).alias("payload"),
    )
    checks = (
        ("obfuscate_email_gone", "email"),
        ("obfuscate_cells_redacted", "cells"),
        ("obfuscate_payload_clean", "payload"),
    )
    return counts.select(
        "layer",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("check"), F.col(c).alias("violations")) for n, c in checks])
        ).alias("c"),
    ).select("c.check", "layer", "c.violations")


# --- neighbours ------------------------------------------------------------------------------


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Multiset difference both ways in one shuffle: rows with ``copies`` < 0 vanished, > 0 appeared."""
    columns = before.columns
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(
        after.select(*columns).withColumn("_sign", F.lit(1))
    )
    return (
        signed.groupBy(*columns)
        .agg(F.sum("_sign").alias("copies"))
        .where(F.col("copies") != 0)
    )


# --- masking -----------------------------------------------------------------------------------


def masking_counts(hits: DataFrame, app_name: str, token: str = MASK_TOKEN) -> DataFrame:
    """How many masked documents show the token where they must and keep what they must."""
    def at(column: str, path: str) -> Column:
        return F.get_json_object(column, path)

    url = at("hit_payload", "$.documentLocation")
    wanted_url = f"%firstName={token}%lastName={token}%email={token}%"
    return hits.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(at("hit_payload", "$.appInfo.name") == token).alias("name_masked"),
        F.count_if(url.like(wanted_url)).alias("url_masked"),
        F.count_if(at("user_payload", "$.contact.email") == token).alias("email_masked"),
        F.count_if(at("user_payload", "$.contact.phone").startswith("+1")).alias("phone_preserved"),
        F.count_if(at("hit_payload", "$.appInfo.appName") == app_name).alias("appname_preserved"),
    )


def structure_changes(df: DataFrame, original: str, masked: str) -> DataFrame:
    """Per leaf path: documents holding it, documents where masking changed or lost it.

    Both documents sit in the same row, so they are compared in place: no join, and no
    common shape of all documents.
    """
    return json_leaves.differences(df, original, masked)
