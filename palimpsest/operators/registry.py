"""From column tags to the registry that drives erasure."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from palimpsest.session import inline_table

# Classifier tags and the PII type each one stands for.
CLASSIFIER_TYPES = {
    "class.email_address": "email",
    "class.name": "name",
    "class.phone_number": "other",
    "class.date_of_birth": "other",
    "class.location": "other",
    "class.us_ssn": "other",
    "class.us_itin": "other",
    "class.passport": "other",
    "class.credit_card": "other",
    "class.bank_number": "other",
    "class.us_bank_number": "other",
    "class.iban_code": "other",
    "class.driver_license": "other",
    "class.ip_address": "other",
}

SCOPES = ("customer", "employee", "all")


def manual_tags(column_tags: DataFrame, tag_key: str = "pii") -> DataFrame:
    return column_tags.where(F.col("tag_name") == tag_key).select(
        "table_name", "column_name", F.col("tag_value").alias("pii_type")
    )


def classifier_tags(column_tags: DataFrame) -> DataFrame:
    """Tags set by an automatic classifier, translated to PII types.

    A column may carry several class tags; email beats name beats other, so the
    result has one row per column whatever the order of the input.
    """
    known = column_tags.where(F.col("tag_name").isin(*CLASSIFIER_TYPES))
    ranked = {"email": "1email", "name": "2name"}
    kind = F.lit(None).cast("string")
    for tag, pii_type in CLASSIFIER_TYPES.items():
        kind = F.when(F.col("tag_name") == tag, ranked.get(pii_type, f"3{pii_type}")).otherwise(kind)
    return known.groupBy("table_name", "column_name").agg(
        F.substring(F.min(kind), 2, 16).alias("pii_type")
    )


def merged_tags(column_tags: DataFrame, tag_key: str = "pii") -> DataFrame:
    """One row per PII column; a manual tag wins over a classified one."""
    both = (
        manual_tags(column_tags, tag_key)
        .withColumn("_rank", F.lit(0))
        .unionByName(classifier_tags(column_tags).withColumn("_rank", F.lit(1)))
    )
    best = F.min(F.struct("_rank", "pii_type")).alias("_best")
    return both.groupBy("table_name", "column_name").agg(best).select(
        "table_name",
        "column_name",
        F.col("_best.pii_type").alias("pii_type"),
        F.when(F.col("_best._rank") == 0, "manual").otherwise("classification").alias("source"),
    )


def table_scopes(table_tags: DataFrame, tag_name: str = "subject_scope") -> DataFrame:
    return table_tags.where(F.col("tag_name") == tag_name).select(
        "table_name",
        F.lower(F.trim(F.coalesce("tag_value", F.lit("customer")))).alias("subject_scope"),
    )


def build_registry(
    column_tags: DataFrame,
    table_tags: DataFrame,
    name_roles: DataFrame,
    payload_columns: DataFrame,
    tag_key: str = "pii",
) -> DataFrame:
    """Derive how each PII column is matched and erased.

    ``name_roles(table_name, column_name, role)`` and
    ``payload_columns(table_name, column_name)`` are the two hints tags cannot
    hold.  All sides are keyed on the column, so nothing is broadcast by decree.
    """
    key = ["table_name", "column_name"]
    tagged = (
        merged_tags(column_tags, tag_key)
        .join(name_roles.select(*key, "role"), key, "left")
        .join(payload_columns.select(*key, F.lit(True).alias("_payload")), key, "left")
        .join(table_scopes(table_tags), "table_name", "left")
    )
    payload = F.coalesce("_payload", F.lit(False))
    kind = F.col("pii_type")
    role = (
        F.when(payload | (kind == "email"), "email")
        .when(kind == "name", F.coalesce("role", F.lit("full_name")))
        .otherwise("none")
    )
    strategy = (
        F.when(payload, "json_key").when(kind == "pnr", "pnr_token").otherwise("scalar_token")
    )
    return tagged.select(
        *key,
        role.alias("identifier_role"),
        (payload | F.coalesce(kind.isin("email", "name"), F.lit(False))).alias("is_identifier"),
        strategy.alias("erase_strategy"),
        F.when(payload, kind).alias("json_tag"),
        F.coalesce("subject_scope", F.lit("customer")).alias("subject_scope"),
    )


def _check_scope(scope: str) -> None:
    if scope not in SCOPES:
        raise ValueError(f"subject scope {scope!r} is not one of {', '.join(SCOPES)}")


def _row_scope():
    return F.lower(F.trim(F.coalesce(F.nullif(F.col("subject_scope"), F.lit("")), F.lit("customer"))))


def in_scope(registry: DataFrame, scope: str = "customer") -> DataFrame:
    _check_scope(scope)
    return registry if scope == "all" else registry.where(_row_scope() == scope)


def skipped_tables(registry: DataFrame, scope: str = "customer") -> DataFrame:
    """Tables of the registry that have no column in scope."""
    kept = in_scope(registry, scope).select("table_name")
    return registry.select("table_name").subtract(kept)


def tables_to_purge(registry: DataFrame, scope: str = "customer") -> DataFrame:
    return in_scope(registry, scope).select("table_name").distinct()


@dataclass(frozen=True)
class TableRules:
    """What the registry says about one table."""

    table: str
    emails: tuple[str, ...] = ()
    payloads: tuple[str, ...] = ()
    names: tuple[tuple[str, str], ...] = ()  # (column, first_name | last_name | full_name)
    scalars: tuple[str, ...] = ()  # overwritten by the token
    masked: tuple[str, ...] = ()  # masked in place
    columns: tuple[str, ...] = field(default=())  # every registered column

    @property
    def names_suffice(self) -> bool:
        """Whether the name columns tell a person: a full name, or both parts; one part is shared by too many."""
        roles = {role for _, role in self.names}
        return "full_name" in roles or roles >= {"first_name", "last_name"}

    @property
    def has_identifiers(self) -> bool:
        return bool(self.emails or self.payloads or self.names)


def registry_rows(registry: DataFrame) -> list[Row]:
    """The registry on the driver: catalog metadata, one row per PII column, needed to build
    expressions exactly as a schema is."""
    return registry.orderBy("table_name", "column_name").collect()


def rules_in_scope(rows: list[Row], scope: str = "customer") -> dict[str, TableRules]:
    _check_scope(scope)
    grouped: dict[str, list[Row]] = {}
    for row in rows:
        if scope in ("all", (row["subject_scope"] or "customer").strip().lower()):
            grouped.setdefault(row["table_name"], []).append(row)
    return {table: _rules(table, columns) for table, columns in grouped.items()}


def rules_by_table(registry: DataFrame, scope: str = "customer") -> dict[str, TableRules]:
    """What the registry says about each table in scope."""
    return rules_in_scope(registry_rows(registry), scope)


def _rules(table: str, rows: list) -> TableRules:
    ids = [r for r in rows if r["is_identifier"]]
    return TableRules(
        table=table,
        emails=tuple(
            r["column_name"]
            for r in ids
            if r["identifier_role"] == "email" and r["erase_strategy"] != "json_key"
        ),
        payloads=tuple(r["column_name"] for r in ids if r["erase_strategy"] == "json_key"),
        names=tuple(
            (r["column_name"], r["identifier_role"])
            for r in ids
            if r["identifier_role"] in ("first_name", "last_name", "full_name")
            and r["erase_strategy"] != "json_key"
        ),
        scalars=tuple(
            r["column_name"] for r in rows if r["erase_strategy"] in ("scalar_token", "pnr_token")
        ),
        masked=tuple(r["column_name"] for r in rows if r["erase_strategy"] == "json_key"),
        columns=tuple(r["column_name"] for r in rows),
    )


def role_map(spark, roles: Mapping[tuple[str, str], str]) -> DataFrame:
    """A role map given as a dictionary, as the DataFrame ``build_registry`` takes."""
    return inline_table(
        spark, "table_name, column_name, role", [(t, c, r) for (t, c), r in sorted(roles.items())]
    )
