"""Request documents in, request queue out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import broadcast_if_small, written

# Request types of the intake system and the erasure mode of each.
MODE_OF_TYPE = {
    "ERASURE": "DELETE",
    "DELETION": "DELETE",
    "RIGHT_TO_DELETE": "DELETE",
    "OPT_OUT": "OBFUSCATE",
    "DO_NOT_SELL": "OBFUSCATE",
    "ACCESS": "OBFUSCATE",
}
DEFAULT_MODE = "OBFUSCATE"
DEADLINE_DAYS = 45

# Alternative keys of a request document, first non-empty one wins.
FIELD_KEYS = {
    "request_id": ("requestQueueRefId", "id", "requestId"),
    "first_name": ("firstName", "first_name"),
    "last_name": ("lastName", "last_name"),
    "email": ("email", "emailAddress"),
    "request_type": ("requestType", "type"),
    "request_date": ("createdDate", "submittedDate"),
}
DOCUMENT_SCHEMA = ", ".join(
    f"{key} string" for keys in FIELD_KEYS.values() for key in keys
) + ", subjectType string"

QUEUE_COLUMNS = (
    "request_id",
    "first_name",
    "last_name",
    "email",
    "request_type",
    "request_date",
    "deadline_date",
    "status",
)


def first_non_empty(*columns: str) -> Column:
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns])


def collapse_type(raw: Column) -> Column:
    """Any request type as one of the two erasure modes; unknown ones only redact."""
    kind = F.upper(F.coalesce(raw, F.lit("")))
    deletes = [t for t, mode in MODE_OF_TYPE.items() if mode == "DELETE"]
    return F.when(kind.isin(*deletes), "DELETE").otherwise(DEFAULT_MODE)


def parse_documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON request documents (one per row) as typed columns."""
    return lines.select(F.from_json(column, DOCUMENT_SCHEMA).alias("d")).select("d.*")


def map_requests(documents: DataFrame) -> DataFrame:
    """Normalise request documents; columns a source does not have count as missing."""
    have = set(documents.columns)
    for keys in FIELD_KEYS.values():
        for key in keys:
            if key not in have:
                documents = documents.withColumn(key, F.lit(None).cast("string"))
    value = {name: first_non_empty(*keys) for name, keys in FIELD_KEYS.items()}
    return documents.select(
        value["request_id"].alias("request_id"),
        F.coalesce(value["first_name"], F.lit("")).alias("first_name"),
        F.coalesce(value["last_name"], F.lit("")).alias("last_name"),
        value["email"].alias("email"),
        collapse_type(value["request_type"]).alias("request_type"),
        value["request_date"].alias("request_date"),
    )


def _is_actionable() -> Column:
    filled = lambda c: F.coalesce(F.length(F.col(c)) > 0, F.lit(False))
    return filled("request_id") & (filled("email") | (filled("first_name") & filled("last_name")))


def actionable(mapped: DataFrame) -> DataFrame:
    return mapped.where(_is_actionable())


def actionable_counts(mapped: DataFrame) -> DataFrame:
    return mapped.agg(
        F.count_if(_is_actionable()).alias("actionable"),
        F.count_if(~_is_actionable()).alias("dropped"),
    )


def upsert_requests(
    queue: DataFrame, incoming: DataFrame, deadline_days: int = DEADLINE_DAYS, today: Column | None = None
) -> DataFrame:
    """The queue after merging ``incoming`` on ``request_id``.

    Open requests are refreshed and become PENDING again, COMPLETE ones stay as
    they are, new ones are added.  One grouped pass over both sides: the key's
    queue row and its incoming row meet in the same group.
    """
    today = F.current_date() if today is None else today
    asked = F.coalesce(F.col("request_date").try_cast("date"), today)
    fresh = incoming.select(
        *[c for c in QUEUE_COLUMNS if c not in ("request_date", "deadline_date", "status")],
        asked.alias("request_date"),
        F.date_add(asked, deadline_days).alias("deadline_date"),
        F.lit("PENDING").alias("status"),
    )
    body = [c for c in QUEUE_COLUMNS if c != "request_id"]
    sides = (
        queue.select(*QUEUE_COLUMNS)
        .withColumn("_new", F.lit(False))
        .unionByName(fresh.withColumn("_new", F.lit(True)))
        .select("request_id", "_new", F.struct(*body).alias("_row"))
    )
    met = sides.groupBy("request_id").agg(
        F.max(F.when(~F.col("_new"), F.col("_row"))).alias("_old"),
        F.max(F.when(F.col("_new"), F.col("_row"))).alias("_in"),
    )
    keep = F.col("_in").isNull() | (F.col("_old.status") == "COMPLETE")
    chosen = F.when(keep & F.col("_old").isNotNull(), F.col("_old")).otherwise(F.col("_in"))
    return met.select("request_id", chosen.alias("_row")).select("request_id", "_row.*")


def request_id(number: Column, prefix: str = "REQ-", width: int = 4) -> Column:
    """``REQ-0007``; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(
        F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    )


def number_requests(subjects: DataFrame, order_by: str = "email", prefix: str = "REQ-", width: int = 4) -> DataFrame:
    """Consecutive request ids in the order of a column.

    A global ``row_number`` puts every row into one task.  Here the rows are
    range-partitioned, numbered inside each partition, and shifted by the sizes of the
    partitions before it (one small row per partition).
    """
    spark = subjects.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        subjects.repartitionByRange(parts, order_by).withColumn("_part", F.spark_partition_id()),
        "numbering",
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(order_by))
    numbered = ranged.withColumn("_local", local).join(F.broadcast(offsets), "_part")
    number = F.col("_before") + F.col("_local")
    return numbered.select(request_id(number, prefix, width).alias("request_id"), *subjects.columns)


def next_request_number(queue: DataFrame) -> DataFrame:
    """Largest numeric id suffix plus one; ids without one count as 0."""
    suffix = F.try_element_at(F.split("request_id", "-"), F.lit(2)).try_cast("int")
    return queue.agg((F.coalesce(F.max(suffix), F.lit(0)) + 1).alias("next_number"))


def candidate_subjects(people: DataFrame, queue: DataFrame, n: int, token: str) -> DataFrame:
    """The first ``n`` emails nobody asked to erase yet, alternating DELETE and OBFUSCATE.

    ``n`` is the feature (a wave of n requests), so the order-and-limit stays a
    top-k; numbering happens on those n rows only.
    """
    asked = queue.select(F.col("email")).where("email is not null").distinct()
    free = (
        people.where(F.col("email").isNotNull() & (F.col("email") != token))
        .select("email")
        .distinct()
        .join(broadcast_if_small(asked), "email", "left_anti")
        .orderBy("email")
        .limit(n)
    )
    position = F.row_number().over(Window.orderBy("email"))
    return free.select(
        "email",
        position.alias("position"),
        F.when(position % 2 == 1, "DELETE").otherwise("OBFUSCATE").alias("request_type"),
    )


def queue_by_status(queue: DataFrame, *also: str) -> DataFrame:
    return queue.groupBy("status", *also).agg(F.count(F.lit(1)).alias("n"))


def pending(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("status") == "PENDING").orderBy("request_id")
