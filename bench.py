"""Headline queries, timed.  Prints one JSON line.

Six masking patterns on three variants of one table (plain, masked at read time,
masked copy), then matching, erasure and evidence.  Every query runs once to
warm up; the best of the timed runs counts.  ``ratios`` gives each masked
variant against the plain one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from palimpsest.plans import catalog  # noqa: E402
from palimpsest.session import get_session, release_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

PATTERN_RUNS = 5
JOB_RUNS = 2
JOBS = (
    "mask_regex_documents",
    "match_email_first",
    "match_payload_orders",
    "erase_customer_profile",
    "erase_hits",
    "no_trace_scan_before",
    "erase_layer_raw",
    "gold_refresh",
    "latest_per_user",
    "json_path_profile",
)


QUERIES = dict(catalog.QUERIES)


def timed(spark, name: str, runs: int) -> float:
    query = QUERIES[name]
    best = float("inf")
    for run in range(runs + 1):
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        if run:
            best = min(best, time.perf_counter() - start)
    return round(best, 4)


def main() -> None:
    spark = get_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    patterns = [n for n in QUERIES if n.startswith("bench_") and n != "bench_warmup"]
    timed(spark, "bench_warmup", 1)
    seconds = {name: timed(spark, name, PATTERN_RUNS) for name in patterns}
    seconds.update({name: timed(spark, name, JOB_RUNS) for name in JOBS})
    ratios = {}
    for name in patterns:
        for variant in catalog.VARIANTS[1:] + ("field_first",):
            if name.endswith(f"_{variant}"):
                base = name.removesuffix(f"_{variant}") + "_baseline"
                ratios[name.removeprefix("bench_")] = round(seconds[name] / seconds[base], 2)
    release_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "ratios": ratios,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
