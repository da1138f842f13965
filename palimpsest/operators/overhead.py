"""What masking costs: collect timings from a query log and compare variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marker a measured statement starts with, and the order of scales.
MARKER = "/* PERFTEST"
SCALE_ORDER = ("1m", "10m", "100m")
BASELINE = "baseline"


def marker(scale: str, variant: str, pattern: str, iteration: int | None = None) -> str:
    tail = "" if iteration is None else f" iter={iteration}"
    return f"{MARKER} scale={scale} variant={variant} pattern={pattern}{tail} */"


def collect_timings(query_log: DataFrame, known: DataFrame, now: Column, hours: int = 6) -> DataFrame:
    """Measured statements of the last hours that are not collected yet.

    The statement id is the key of both sides; a statement without ``iter=``
    gets a null iteration.
    """
    text = F.col("statement_text")

    def part(pattern: str) -> Column:
        return F.regexp_extract(text, pattern, 1)

    recent = query_log.where(
        text.startswith(MARKER)
        & (F.col("statement_type") == "SELECT")
        & (F.col("started_at") >= now - F.make_dt_interval(hours=F.lit(hours)))
    )
    return recent.join(known.select("statement_id"), "statement_id", "left_anti").select(
        now.alias("collected_at"),
        part("scale=([0-9a-z]+)").alias("scale"),
        part("variant=([a-z]+)").alias("variant"),
        part("pattern=([a-z_]+)").alias("pattern"),
        part("iter=([0-9]+)").try_cast("int").alias("iter"),
        "execution_ms",
        "total_ms",
        "compilation_ms",
        "read_rows",
        "read_bytes",
        "io_cache_pct",
        "statement_id",
        "started_at",
    )


def _against_baseline(stats: DataFrame, value: str) -> DataFrame:
    base = stats.where(F.col("variant") == BASELINE).select(
        "scale", "pattern", F.col(value).alias("_base")
    )
    over = F.col(value) - F.col("_base")
    return stats.join(base, ["scale", "pattern"]).select(
        *stats.columns,
        F.round(over, 0).alias("overhead_ms"),
        F.round(F.lit(100.0) * over / F.nullif(F.col("_base"), F.lit(0)), 1).alias("overhead_pct"),
    )


def summary_median(results: DataFrame) -> DataFrame:
    """Median execution time and overhead over the baseline, per scale, pattern and variant."""
    stats = results.groupBy("scale", "pattern", "variant").agg(
        F.percentile("execution_ms", F.lit(0.5)).alias("p50_ms")
    )
    return _against_baseline(stats, "p50_ms").withColumn("p50_ms", F.round("p50_ms", 0))


def summary_best(results: DataFrame) -> DataFrame:
    """Best execution and total time, rows read, overhead, and a sortable scale label."""
    stats = results.groupBy("scale", "pattern", "variant").agg(
        F.min("execution_ms").alias("exec_ms"),
        F.min("total_ms").alias("total_ms"),
        F.max("read_rows").alias("read_rows"),
    )
    order = scale_order(F.col("scale"))
    return (
        _against_baseline(stats, "exec_ms")
        .withColumn("scale_ord", order)
        .withColumn("scale_sortable", F.concat(order.cast("string"), F.lit("_"), F.col("scale")))
    )


def scale_order(scale: Column) -> Column:
    ranked = F.when(scale == SCALE_ORDER[0], 1)
    for i, name in enumerate(SCALE_ORDER[1:], start=2):
        ranked = ranked.when(scale == name, i)
    return ranked


def report_order(summary: DataFrame) -> DataFrame:
    """Scales by size, then pattern, then baseline before the masked variants."""
    variant = F.when(F.col("variant") == BASELINE, 1).when(F.col("variant") == "dynamic", 2).otherwise(3)
    return summary.orderBy(F.coalesce(scale_order(F.col("scale")), F.lit(9)), "pattern", variant)


def chart_rows(best: DataFrame, **fixed: str) -> DataFrame:
    """The summary restricted to one scale, pattern and/or variant."""
    for column, value in fixed.items():
        best = best.where(F.col(column) == value)
    return best
