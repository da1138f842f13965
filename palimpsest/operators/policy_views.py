"""Column tags decide which policy masks which column: at read time or as a rewritten copy."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from palimpsest.functions.masking import mask_expr, mask_variant
from palimpsest.session import inline_table


def tags_of_table(column_tags: DataFrame, table: str, tag_key: str = "pii") -> dict[str, str]:
    """``column -> tag value`` of one table (metadata of one table, so it is read on the driver)."""
    rows = column_tags.where(
        (F.col("table_name") == table) & (F.col("tag_name") == tag_key)
    ).select("column_name", "tag_value")
    return {r["column_name"]: r["tag_value"] for r in rows.collect()}


def apply_policies(
    df: DataFrame,
    column_policies: Mapping[str, str],
    policies: Mapping[str, Mapping],
    principal_groups: Iterable[str] = (),
    exempt_groups: Collection[str] = (),
    **options,
) -> DataFrame:
    """Dynamic masking: the table as this principal may see it.

    Members of an exempt group get the raw select.  The masks are plain lazy
    columns: an unread one costs nothing, and filters on other columns still
    reach the scan.  VARIANT columns are masked through their text form.
    """
    if set(principal_groups) & set(exempt_groups):
        return df
    # names as Spark resolves them: a tag that missed its column would leave it in clear
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    named = {c if exact else c.lower(): t for c, t in column_policies.items()}
    own = {c if exact else c.lower() for c in df.columns}
    if set(named) - own:
        raise ValueError(f"tags name columns that the table does not have: {sorted(set(named) - own)}")
    unknown = set(named.values()) - set(policies)
    if unknown:
        raise ValueError(f"columns are tagged with types that have no policy: {sorted(unknown)}")

    def shown(field) -> Column:
        tag = named.get(field.name if exact else field.name.lower())
        if tag is None:
            return F.col(field.name)
        mask = mask_variant if isinstance(field.dataType, VariantType) else mask_expr
        return mask(field.name, policies[tag], **options).alias(field.name)

    return df.select(*[shown(field) for field in df.schema.fields])


def materialize_masked(
    df: DataFrame, column_policies: Mapping[str, str], policies: Mapping[str, Mapping], path: str
) -> DataFrame:
    """Mask once, write the copy, and return a scan of it: later reads pay nothing."""
    masked = apply_policies(df, column_policies, policies)
    masked.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(masked.schema).parquet(path)


def tag_inventory(column_tags: DataFrame, tag_key: str = "pii") -> DataFrame:
    """How many columns of each table carry each value of the tag."""
    return (
        column_tags.where(F.col("tag_name") == tag_key)
        .groupBy("table_name", "tag_value")
        .agg(F.count(F.lit(1)).alias("columns"))
    )


def required_tag_values(column_tags: DataFrame, policy_names: Iterable[str], tag_key: str = "pii") -> DataFrame:
    """Values the tag must allow: every policy name and every value in use."""
    spark = column_tags.sparkSession
    named = inline_table(spark, "tag_value", [(p,) for p in sorted(policy_names)])
    used = column_tags.where(F.col("tag_name") == tag_key).select("tag_value")
    return named.unionByName(used).distinct()


def missing_tag_values(required: DataFrame, allowed: DataFrame) -> DataFrame:
    """Required values the tag does not allow yet."""
    return required.join(allowed.select("tag_value"), "tag_value", "left_anti")


def before_after(
    df: DataFrame, fields: Mapping[str, tuple[Column, Column]], order_by: str, rows: int = 10
) -> DataFrame:
    """Raw and masked values side by side for the first ``rows`` rows of the order."""
    shown = []
    for name, (raw, masked) in fields.items():
        shown += [raw.alias(f"{name}_raw"), masked.alias(f"{name}_masked")]
    return df.orderBy(order_by).limit(rows).select(order_by, *shown)
