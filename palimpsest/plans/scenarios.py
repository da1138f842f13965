"""Runs that have to write something before they can be queried.

A scenario is built once per application and data folder, below the shared
scratch folder, and then read by several queries: first of all the tables of
the data model, derived from the given ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.masking import DEFAULT_POLICIES
from palimpsest.operators import erasure, matching, validation
from palimpsest.operators.policy_views import apply_policies, materialize_masked
from palimpsest.operators.registry import TableRules, rules_by_table
from palimpsest.plans import testdata
from palimpsest.session import scratch_dir, scratch_epoch, written
from palimpsest.sources import landing, paths
from palimpsest.sources.catalog_folders import REGISTRY, REQUESTS, FolderCatalog
from palimpsest.sources.file_index import FileIndex
from palimpsest.sources.rewrite import erase_files, layer_index, layer_rows, replace_table
from palimpsest.streaming.medallion import RAW_SCHEMA, Erasure, Lakehouse

_built: dict[tuple, object] = {}


def once(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], object]):
    key = (scratch_epoch(spark), name, sf_dir)
    if key not in _built:
        _built[key] = build()
    return _built[key]


# --- the data model as stored tables ---------------------------------------------------


#: A given table may be one file; its rows are scanned with costly expressions, so they are spread.
ROWS_PER_FILE = 50_000


def stored(spark: SparkSession, sf_dir: str, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written once and then scanned like any table."""
    return once(spark, f"table-{name}", sf_dir, lambda: written(derive(), name, ROWS_PER_FILE))


def erasure_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    derived = testdata.erasure_tables(spark, sf_dir)
    return {name: stored(spark, sf_dir, name, lambda n=name: derived[n]) for name in derived}


def request_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "queue", lambda: testdata.request_queue(spark, sf_dir))


def layer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "layer_requests", lambda: testdata.layer_requests(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "raw_events", lambda: testdata.raw_events(spark, sf_dir))


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits_variants(spark, sf_dir)["baseline"]


def rules(spark: SparkSession, scope: str = "customer"):
    """What the registry says about the six tables (catalog metadata)."""
    return once(spark, f"rules-{scope}", "", lambda: rules_by_table(testdata.registry(spark), scope))


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "notes", lambda: testdata.notes(spark, sf_dir))


NOTE_RULES = TableRules("notes", payloads=("note",), masked=("note",), columns=("note",))


@dataclass(frozen=True)
class InPlace:
    """A table of many files, erased in place."""

    table: DataFrame
    files: dict[str, int]


def hits_in_place(spark: SparkSession, sf_dir: str) -> InPlace:
    """The payload table in one file per range of balances, erased file by file."""

    def build() -> InPlace:
        path = scratch_dir(spark, "hits-in-place")
        people = testdata.person(spark, sf_dir)
        rows = testdata.tables_of(people)["app_hits_json"].join(
            people.select(F.col("id").alias("hit_id"), F.floor(F.col("c_acctbal") / 100).alias("bucket")), "hit_id"
        )
        rows.repartition(16, "bucket").write.partitionBy("bucket").parquet(path)
        subjects = matching.subjects_of(request_queue(spark, sf_dir).where("status = 'PENDING'"))
        # requests may name everybody: then no file is left to tell the columns
        schema = rows.drop("bucket").schema
        done = erase_files(spark, path, rules(spark)["app_hits_json"], subjects, schema=schema)
        return InPlace(layer_rows(spark, schema, path), done)

    return once(spark, "hits-in-place", sf_dir, build)


# --- masked tables ------------------------------------------------------------------


def hits_variants(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The hit table three ways: plain, masked at read time, and a masked copy."""

    def build() -> dict[str, DataFrame]:
        baseline = stored(spark, sf_dir, "hits", lambda: testdata.hits(spark, sf_dir))
        return {
            "baseline": baseline,
            "dynamic": apply_policies(baseline, testdata.HIT_TAGS, DEFAULT_POLICIES),
            "materialized": materialize_masked(
                baseline, testdata.HIT_TAGS, DEFAULT_POLICIES, scratch_dir(spark, "hits-masked")
            ),
        }

    return once(spark, "hits", sf_dir, build)


# --- the medallion -------------------------------------------------------------------


@dataclass(frozen=True)
class Story:
    """First load, erasure, second load.

    The second wave holds the ``error`` events of the whole period: they arrive
    late, and some belong to users that were erased before.
    """

    house: Lakehouse
    erasure: Erasure
    landed_first: DataFrame
    after_erasure: dict[str, DataFrame]


FIRST_WAVE = "event_type <> 'error'"
SECOND_WAVE = "event_type = 'error'"


def _land(spark: SparkSession, sf_dir: str, folder: str, wave: str) -> None:
    events = raw_events(spark, sf_dir).where(wave)
    landing.write_landing(events, folder, files=8)


def story(spark: SparkSession, sf_dir: str, latest_only: bool = False) -> Story:
    def build() -> Story:
        root = scratch_dir(spark, "lakehouse")
        zone = paths.below(root, "landing")
        house = Lakehouse(spark, zone, paths.below(root, "tables"), latest_only)
        _land(spark, sf_dir, paths.below(zone, "initial"), FIRST_WAVE)
        house.run()
        landed = landing.landing_counts(spark, zone)
        landed = written(landed, "landed")
        run = house.erase(layer_requests(spark, sf_dir))
        after = {name: written(df, f"after-{name}") for name, df in house.base_layers().items()}
        _land(spark, sf_dir, paths.below(zone, "incremental"), SECOND_WAVE)
        house.run()
        return Story(house, run, landed, after)

    return once(spark, f"story-{latest_only}", sf_dir, build)


def refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw after the same files were read again from scratch by a second set of tables."""

    def build() -> DataFrame:
        first = story(spark, sf_dir).house
        second = Lakehouse(spark, first.landing, scratch_dir(spark, "rebuilt"))
        second.full_refresh()
        return second.raw()

    return once(spark, "refreshed", sf_dir, build)


@dataclass(frozen=True)
class Indexed:
    """A layer of one file per group of users, its index, and the users asked for."""

    index: FileIndex
    users: DataFrame


def indexed_layer(spark: SparkSession, sf_dir: str) -> Indexed:
    def build() -> Indexed:
        root = scratch_dir(spark, "indexed")
        events = raw_events(spark, sf_dir).drop("event_type")
        group = F.pmod(F.substring("user_id", 2, 12).cast("long"), F.lit(97)).alias("bucket")
        events.select("*", group).repartition("bucket").write.partitionBy("bucket").parquet(paths.below(root, "layer"))
        index = layer_index(spark, paths.below(root, "index"), paths.below(root, "layer"), RAW_SCHEMA)
        index.refresh()
        asked = layer_requests(spark, sf_dir).where("request_type = 'DELETE'")
        return Indexed(index, written(matching.resolve_subject_keys(raw_events(spark, sf_dir), asked).select("user_id").distinct(), "asked-users"))

    return once(spark, "indexed", sf_dir, build)


@dataclass(frozen=True)
class NamedRun:
    """A run over targets by name, and the central queue closed by its manifest."""

    result: erasure.RunResult
    queue: DataFrame


NAMED_TARGETS = "crm.people, ops.travel,hr.staff\nlab.blank , lab.absent, crm.people"
HOMES = {
    "crm.people": ("customer_profile", "contact_email_only"),
    "ops.travel": ("booking", "loyalty_split", "app_hits_json"),
    "hr.staff": ("employee_crew",),
}


def named_run(spark: SparkSession, sf_dir: str) -> NamedRun:
    """Tables, registries and a central queue in folders; erased, published and validated by name."""

    def build() -> NamedRun:
        catalog = FolderCatalog(spark, scratch_dir(spark, "catalog"))
        tables, registry = erasure_tables(spark, sf_dir), testdata.registry(spark)
        for name, own in HOMES.items():
            for table in own:
                tables[table].write.parquet(catalog.folder(name, table))
            registry.where(F.col("table_name").isin(*own)).write.parquet(catalog.folder(name, REGISTRY))
        registry.limit(0).write.parquet(catalog.folder("lab.blank", REGISTRY))
        central = catalog.folder("ops.central", REQUESTS)
        request_queue(spark, sf_dir).write.parquet(central)
        result = erasure.run_targets(
            spark, catalog.targets(NAMED_TARGETS, "crm.people"), dry_run=False, central_requests=spark.read.parquet(central),
            verdict_fields=("email",), publish=catalog.publish,
        )
        # requests that come while the run is on, found in the queue when it is closed
        late = request_queue(spark, sf_dir).where("status = 'COMPLETE'").withColumn("status", F.lit("PENDING"))
        late.withColumn("request_id", F.concat(F.lit("LATE-"), "request_id")).write.mode("append").parquet(central)
        return NamedRun(result, written(erasure.close_requests(spark.read.parquet(central), result.manifest), "closed"))

    return once(spark, "named-run", sf_dir, build)


def purge_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Erase a written table in place, then look for the subjects in the bytes that are left.

    ``files``, ``rows`` of the published table, and ``rows_with_trace``.
    """
    def build() -> DataFrame:
        path = scratch_dir(spark, "purge")
        testdata.erasure_tables(spark, sf_dir)["customer_profile"].write.parquet(path)
        profile = {"customer_profile": rules(spark)["customer_profile"]}
        subjects = matching.subjects_of(request_queue(spark, sf_dir).where("status = 'PENDING'"))
        erased = erasure.erase_table(spark.read.parquet(path), profile["customer_profile"], subjects)
        after = replace_table(erased, path)
        found = validation.no_trace_scan("t", {"customer_profile": after}, profile, subjects, ("email",))
        rows = after.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("long").alias("rows_with_trace"))
        trace = found.agg(
            F.lit(0).cast("long").alias("rows"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_with_trace"),
        )
        return rows.unionByName(trace).agg(
            F.sum("rows").alias("rows"), F.sum("rows_with_trace").alias("rows_with_trace")
        )

    return once(spark, "purge", sf_dir, build)
