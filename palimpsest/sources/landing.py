"""The landing zone: JSON-lines files with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANDING_SCHEMA = (
    "event_id string, user_id string, email string, full_name string, "
    "profile_json string, revenue double, event_ts string, _ingest_ts string"
)
# Seen files are kept in mind for this long; older ones would be forgotten and, if rewritten, read again.
SEEN_FOR = "36500d"
# A file of a layer is rewritten by one task, so its rows are bounded (some 100 MB of JSON).
ROWS_PER_FILE = 250_000
LANDING_COLUMNS = [c.split()[0] for c in LANDING_SCHEMA.split(", ")]


def read_landing(spark: SparkSession, path: str, schema: str = LANDING_SCHEMA) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
        .json(path)
    )


def stream_landing(
    spark: SparkSession, path: str, schema: str = LANDING_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    """New files only; what was seen is remembered by path in the query's checkpoint."""
    reader = (
        spark.readStream.schema(schema)
        .option("maxFileAge", SEEN_FOR)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def write_landing(df: DataFrame, path: str, files: int, mode: str = "overwrite") -> None:
    """JSON files, rows spread evenly over a fixed number of them; more rows than so many files
    may hold are written where they are read, a bounded number a file."""
    rows = df.select(*LANDING_COLUMNS)
    if df.count() <= files * ROWS_PER_FILE:
        rows = rows.repartition(files)
    rows.write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).json(path)


def files_view(spark: SparkSession, path: str, name: str) -> None:
    """The files of a folder as a temporary view, for plain SQL over them."""
    read_landing(spark, path).createOrReplaceTempView(name)


def landing_counts(spark: SparkSession, path: str) -> DataFrame:
    """Records per sub-folder of the landing zone, and over all of it."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)/[^/]+$", 1)
    per = (
        read_landing(spark, path)
        .select(folder.alias("folder"))
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    total = per.agg(F.lit("all").alias("folder"), F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
    return per.unionByName(total)
