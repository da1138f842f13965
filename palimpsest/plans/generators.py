"""The same tables from nothing but a row count, for tests and trials of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators import intake
from palimpsest.plans import testdata


def hits(spark: SparkSession, n: int) -> DataFrame:
    """``n`` app hits with two payload columns."""
    return testdata.hits_of(
        spark.range(n).select(
            F.col("id").alias("o_orderkey"),
            F.pmod(F.xxhash64("id"), F.lit(n)).alias("o_custkey"),
            testdata.pick(("GUEST", "MEMBER"), F.col("id") % 2).alias("o_orderstatus"),
        )
    )


def people(spark: SparkSession, n: int, first_id: int = 0) -> DataFrame:
    key = F.col("id")
    return spark.range(first_id, first_id + n).select(
        key,
        *[c.alias(name) for name, c in testdata.person_columns(key).items()],
        (key % 25).cast("int").alias("c_nationkey"),
        testdata.pick(("HOUSEHOLD", "BUILDING"), key % 2).alias("c_mktsegment"),
    )


def erasure_tables(spark: SparkSession, n: int, planted: int = 10) -> dict[str, DataFrame]:
    """The six erasure tables: ``n`` other people, and subjects from id 1,000,000 on."""
    return testdata.tables_of(people(spark, n).unionByName(people(spark, planted, 1_000_000)))


def user_events(spark: SparkSession, users: int, events: int, first_id: int = 0) -> DataFrame:
    """``users`` x ``events`` landing records; later events are older but were ingested later."""
    who = people(spark, users, first_id).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(events - 1))))
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    start = F.lit("2026-07-01 12:00:00").cast("timestamp")
    user = F.concat(F.lit("U"), F.lpad(F.col("id").cast("string"), 12, "0"))
    revenue = F.round(F.pmod(F.xxhash64("id", "n"), F.lit(50_000)) / 100, 2)
    profile = F.struct(
        F.struct("email", F.col("full_name").alias("name")).alias("contact"),
        F.struct(testdata.pick(testdata.TIERS, F.col("id") % 3).alias("tier"), revenue.alias("ltv")).alias("loyalty"),
    )
    return who.select(
        F.concat_ws("-", user, F.col("n").cast("string")).alias("event_id"),
        user.alias("user_id"),
        "email",
        "full_name",
        F.to_json(profile).alias("profile_json"),
        revenue.alias("revenue"),
        F.date_format(start - F.make_dt_interval(days=F.col("n")), stamp).alias("event_ts"),
        F.date_format(start + F.make_dt_interval(mins=F.col("n")), stamp).alias("_ingest_ts"),
    )


def request_wave(candidates: DataFrame, first_number: int = 1) -> DataFrame:
    """Numbered PENDING requests of the streaming queue for picked subjects (``email, position, request_type``)."""
    number = F.col("position") + F.lit(first_number - 1)
    return candidates.select(
        intake.request_id(number, width=3).alias("request_id"),
        F.col("email").alias("subject_email"),
        "request_type",
        F.lit("PENDING").alias("status"),
        F.current_date().alias("request_date"),
        F.date_add(F.current_date(), 45).alias("deadline_date"),
    )
