"""Landing files -> raw -> bronze -> silver -> gold, with erasure at every layer.

Each hop is its own stateless stream with its own checkpoint.  A micro-batch is
written to the folder ``batch_id=N`` of its layer; a replayed batch that was
already complete is skipped, an incomplete one overwritten, so every hop is
exactly-once.  Layers are read by path, and erasure rewrites files under their
own path, which is why a downstream stream never sees an erasure as new data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from palimpsest.functions.masking import ERASED_TOKEN
from palimpsest.operators import erasure, matching, validation
from palimpsest.session import written
from palimpsest.sources import landing, paths, rewrite
from palimpsest.sources.file_index import FileIndex

RAW_SCHEMA = StructType(
    [
        StructField(name, DoubleType() if name == "revenue" else StringType())
        for name in landing.LANDING_COLUMNS
    ]
)
#: Batches of latest rows, or folds of one level, that are folded when a run has made so many.
FOLD_AT = 8
SILVER_SCHEMA = StructType([*RAW_SCHEMA.fields[:-1], StructField("_silver_ts", TimestampType())])


# --- the hops as plain functions -----------------------------------------------------


def bronze_of(raw: DataFrame) -> DataFrame:
    return raw.select(*landing.LANDING_COLUMNS)


def silver_of(bronze: DataFrame) -> DataFrame:
    """Rows without a user id are dropped; revenue is a double; processing time is added."""
    return bronze.where(F.col("user_id").isNotNull()).select(
        "event_id",
        "user_id",
        "email",
        "full_name",
        "profile_json",
        F.col("revenue").cast("double").alias("revenue"),
        "event_ts",
        F.current_timestamp().alias("_silver_ts"),
    )


def latest_per_user(changes: DataFrame, key: str = "user_id", sequence: str = "_ingest_ts") -> DataFrame:
    """One row per key, the latest by sequence (event id breaks ties).

    ``max_by`` keeps one candidate per key and task before the shuffle, so a key
    with a third of the rows costs one row per task, where a window would sort
    them all in one.
    """
    columns = changes.columns
    order = F.struct(F.col(sequence), F.col("event_id"))
    return (
        changes.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by(F.struct(*columns), order).alias("_row"))
        .select("_row.*")
    )


def gold_lifetime(silver: DataFrame) -> DataFrame:
    """Per user over all events (append silver)."""
    return silver.groupBy("user_id").agg(
        F.sum("revenue").alias("lifetime_revenue"),
        F.count(F.lit(1)).alias("event_count"),
        F.max("event_ts").alias("last_event_ts"),
    )


def gold_latest(silver: DataFrame) -> DataFrame:
    """Per user over its one current row (latest-per-key silver)."""
    return silver.groupBy("user_id").agg(
        F.sum("revenue").alias("latest_revenue"), F.max("event_ts").alias("last_event_ts")
    )


# --- sinks ------------------------------------------------------------------------------


def _write_batch(layer: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = paths.below(layer, f"batch_id={batch_id}")
        if not paths.exists(batch.sparkSession, f"{folder}/_SUCCESS"):
            batch.write.mode("overwrite").option("maxRecordsPerFile", landing.ROWS_PER_FILE).parquet(folder)

    return write


def _run(stream: DataFrame, layer: str, checkpoint: str) -> None:
    """Process what is there, then stop."""
    query = (
        stream.writeStream.foreachBatch(_write_batch(layer))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@dataclass(frozen=True)
class Lakehouse:
    """Folders of one medallion.

    ``latest_only`` keeps one current row per user in silver.  ``files_per_batch`` bounds
    the micro-batches of every hop: a first load of many files runs as many batches.
    """

    spark: SparkSession
    landing: str
    root: str
    latest_only: bool = False
    files_per_batch: int | None = None

    def _layer(self, name: str) -> str:
        return paths.below(self.root, name)

    def _checkpoint(self, name: str) -> str:
        return paths.below(self.root, "_checkpoints", name)

    @property
    def silver_schema(self) -> StructType:
        return RAW_SCHEMA if self.latest_only else SILVER_SCHEMA

    # --- streams -------------------------------------------------------------------------

    def _read_layer_stream(self, name: str) -> DataFrame:
        reader = (
            self.spark.readStream.schema(RAW_SCHEMA)
            .option("maxFileAge", landing.SEEN_FOR)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
        )
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        return reader.parquet(self._layer(name))

    def ingest_raw(self) -> None:
        stream = landing.stream_landing(self.spark, self.landing, files_per_batch=self.files_per_batch)
        _run(stream, self._layer("raw"), self._checkpoint("raw"))

    def ingest_bronze(self) -> None:
        paths.make_dirs(self.spark, self._layer("raw"))
        _run(bronze_of(self._read_layer_stream("raw")), self._layer("bronze"), self._checkpoint("bronze"))

    def ingest_silver(self) -> None:
        """Append variant: validated events.  Latest-only variant: each batch reduced to its newest row
        per user and appended; ``silver()`` merges what there is, ``compact_silver()`` folds it."""
        paths.make_dirs(self.spark, self._layer("bronze"))
        feed = self._read_layer_stream("bronze")
        if not self.latest_only:
            _run(silver_of(feed), self._layer("silver"), self._checkpoint("silver"))
            return
        append = _write_batch(self._layer("silver"))
        query = (
            feed.writeStream.foreachBatch(lambda df, n: append(latest_per_user(df), n))
            .option("checkpointLocation", self._checkpoint("silver"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def refresh_gold(self) -> DataFrame:
        gold = gold_latest if self.latest_only else gold_lifetime
        return rewrite.replace_table(gold(self.silver()), self._layer("gold"))

    def run(self) -> None:
        """Incremental update: every hop takes what is new, silver's many batches are folded, gold is recomputed."""
        self.ingest_raw()
        self.ingest_bronze()
        self.ingest_silver()
        self.compact_silver(FOLD_AT)
        self.refresh_gold()

    def full_refresh(self) -> None:
        """Forget every layer and checkpoint, and read all source files again."""
        for name in ("raw", "bronze", "silver", "gold", "_checkpoints", "_staging", "_index"):
            paths.delete(self.spark, self._layer(name))
        self.run()

    # --- tables -----------------------------------------------------------------------------

    def _table(self, name: str, schema: StructType) -> DataFrame:
        paths.make_dirs(self.spark, self._layer(name))
        return (
            self.spark.read.schema(schema)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .parquet(self._layer(name))
        )

    def raw(self) -> DataFrame:
        return self._table("raw", RAW_SCHEMA)

    def bronze(self) -> DataFrame:
        return self._table("bronze", RAW_SCHEMA)

    def silver(self) -> DataFrame:
        stored = self._table("silver", self.silver_schema)
        return latest_per_user(stored) if self.latest_only else stored

    def gold(self) -> DataFrame:
        return self.spark.read.parquet(self._layer("gold"))

    def base_layers(self) -> dict[str, DataFrame]:
        return {"raw": self.raw(), "bronze": self.bronze(), "silver": self.silver()}

    def all_layers(self) -> dict[str, DataFrame]:
        return {**self.base_layers(), "gold": self.gold()}

    def files(self) -> DataFrame:
        return landing.read_landing(self.spark, self.landing)

    def _folds(self) -> dict[int, list[str]]:
        """The folders of silver by level: batches are 0, what folds level n is n + 1."""
        levels: dict[int, list[str]] = {}
        for path in paths.children(self.spark, self._layer("silver")):
            kind, _, number = paths.name_of(path).partition("=")
            if kind in ("batch_id", "fold_id"):
                levels.setdefault(int(number.split("-")[0]) if kind == "fold_id" else 0, []).append(path)
        return levels

    def compact_silver(self, fan_in: int = 2) -> int:
        """Fold the latest-only silver where a level has ``fan_in`` folders or more; how many folds.

        Folders of one level become one of the next, so each row is rewritten once per
        level, and a read meets fewer than ``fan_in`` folders of each.  A fold is written
        outside the layer and appears in it by one rename; only then do its sources go.
        At any moment in between rows are there once or twice, which is the same to a
        table of latest rows, and what a run that died left outside is thrown away.
        """
        if not self.latest_only:
            return 0
        staging = paths.below(self.root, "_staging", "silver")
        paths.delete(self.spark, staging)
        done, level = 0, 0
        while folders := self._folds().get(level):
            if len(folders) >= fan_in:
                newest = max(int(paths.name_of(p).replace("-", "=").split("=")[-1]) for p in folders)
                name = f"fold_id={level + 1}-{newest}"
                fold = paths.below(staging, name)
                rows = self.spark.read.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
                latest_per_user(rows.parquet(*folders)).write.option("maxRecordsPerFile", landing.ROWS_PER_FILE).parquet(fold)
                paths.move(self.spark, fold, paths.below(self._layer("silver"), name))
                for folder in folders:
                    paths.delete(self.spark, folder)
                done += 1
            level += 1
        return done

    # --- erasure --------------------------------------------------------------------------------

    def index(self, name: str) -> FileIndex:
        """Which files of a layer, or of the landing zone, may hold a user (layers: or an address)."""
        root = paths.below(self.root, "_index", name)
        if name == "landing":
            return rewrite.landing_index(self.spark, root, self.landing)
        schema = self.silver_schema if name == "silver" else RAW_SCHEMA
        paths.make_dirs(self.spark, self._layer(name))
        return rewrite.layer_index(self.spark, root, self._layer(name), schema)

    def refresh_index(self) -> dict[str, int]:
        """Read the files that came since the last time, once; how many per layer."""
        return {name: self.index(name).refresh() for name in INDEXED}

    def _held(self, users: DataFrame) -> "Held":
        """The files that may hold one of the users."""
        files = {name: written(self.index(name).candidates("user_id", users.select("user_id")), f"held-{name}") for name in INDEXED}
        return Held(files, {name: self.index(name).rows(df) for name, df in files.items()})

    def _held_layers(self, held: "Held") -> dict[str, DataFrame]:
        silver = held.rows["silver"]
        return {
            "raw": held.rows["raw"],
            "bronze": held.rows["bronze"],
            "silver": latest_per_user(silver) if self.latest_only else silver,
            "gold": self.gold(),
        }

    def _resolve(self, requests: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Requests asked for, the users they name, and the mode of each user, all written down."""
        pending = requests.where(F.col("status") == "PENDING")
        asked = written(pending.select("request_id"), "asked")
        self.refresh_index()
        raw, mails = self.index("raw"), pending.select(F.lower(F.trim("subject_email")))
        resolved = written(matching.resolve_subject_keys(raw.rows(raw.candidates("email", mails)), pending), "resolved")
        return asked, resolved, written(matching.user_modes(resolved), "modes")

    def plan(self, requests: DataFrame) -> DataFrame:
        """Dry run of ``erase``: ``layer, rows, files`` it would touch; no layer, file or request changes.

        ``files`` is null for gold, which is recomputed and not rewritten.
        """
        _, _, modes = self._resolve(requests)
        held = self._held(modes)
        stored = (("raw", RAW_SCHEMA), ("bronze", RAW_SCHEMA), ("silver", self.silver_schema))
        found = {name: rewrite.layer_files(self.spark, self._layer(name), schema, modes, held.rows[name]) for name, schema in stored}
        found["landing"] = rewrite.landing_files(self.spark, self.landing, modes, held.rows["landing"], self.index("landing").broken_files())
        named = [df.select(F.lit(name).alias("layer")) for name, df in found.items()]
        files = reduce(DataFrame.unionAll, named).groupBy("layer").agg(F.count(F.lit(1)).alias("files"))
        lines = held.rows["landing"].select(F.get_json_object("value", "$.user_id").alias("user_id"))
        rows = erasure.layer_match_counts({**self._held_layers(held), "landing": lines}, modes)
        none = F.when(F.col("layer") != "gold", F.lit(0).cast("long"))
        return rows.join(files, "layer", "left").select("layer", "rows", F.coalesce("files", none).alias("files"))

    def erase(self, requests: DataFrame, token: str = ERASED_TOKEN, scrub_files: bool = True) -> "Erasure":
        """Erase all PENDING requests from the source files and every layer.

        The keys are resolved from raw, so raw comes last: a run that dies on
        the way resolves the same subjects again and simply repeats the rest.
        The resolved keys are written down, because raw loses them in the end.
        Gold is recomputed only if something was deleted.  Only files that may hold a
        subject are opened; the checks afterwards read everything.
        """
        asked, resolved, modes = self._resolve(requests)
        paths.delete(self.spark, paths.below(self.root, "_staging"))  # a fold that never came in holds people too
        held = self._held(modes)
        before = validation.kept(erasure.layer_match_counts(self._held_layers(held), modes))
        changed = {}
        if scrub_files:
            broken = self.index("landing").broken_files()
            changed["landing"] = rewrite.scrub_landing(self.spark, self.landing, modes, token, held.rows["landing"], broken)
        refreshed = erasure.needs_gold_refresh(modes)
        for name, schema in (("silver", self.silver_schema), ("bronze", RAW_SCHEMA), ("raw", RAW_SCHEMA)):
            changed[name] = rewrite.erase_layer_files(self.spark, self._layer(name), schema, modes, token, held.rows[name])
            if name == "silver" and refreshed:
                self.refresh_gold()
        opened = {name: df.count() for name, df in held.files.items()}
        return Erasure(self, asked, resolved, modes, before, changed, refreshed, opened)


#: What has an index of its files.
INDEXED = ("landing", "raw", "bronze", "silver")


@dataclass(frozen=True)
class Held:
    """Files that may hold some users (``_file``), and their rows; by layer."""

    files: dict[str, DataFrame]
    rows: dict[str, DataFrame]


@dataclass(frozen=True)
class Erasure:
    """What one erasure run did, and the checks that it left nothing behind."""

    house: Lakehouse
    asked: DataFrame
    resolved: DataFrame
    modes: DataFrame
    counts_before: DataFrame
    changed_files: dict[str, dict[str, int]]
    gold_refreshed: bool
    #: Files that were opened to look for the subjects, per layer and in the landing zone.
    opened_files: dict[str, int]

    def counts_after(self) -> DataFrame:
        return erasure.layer_match_counts(self.house.all_layers(), self.modes)

    def violations(self, token: str = ERASED_TOKEN) -> DataFrame:
        """Every invariant over the layers and the source files: ``check, layer, violations``."""
        layers = {**self.house.base_layers(), "landing": self.house.files()}
        return validation.delete_violations(self.resolved, layers).unionByName(
            validation.obfuscate_violations(self.resolved, layers, token)
        )

    def passed(self) -> bool:
        return self.violations().where("violations > 0").isEmpty()

    def complete(self, requests: DataFrame, scrub: bool = False, token: str = ERASED_TOKEN) -> DataFrame:
        """The queue with this run's requests COMPLETE (also those that matched nothing);
        requests that arrived since stay open.  ``scrub`` puts the token for their addresses."""
        if not self.passed():
            raise RuntimeError("the erasure left a trace; the requests stay PENDING")
        if scrub:
            return erasure.scrub_queue(requests, self.asked, token, ("subject_email",))
        return erasure.complete_requests(requests, self.asked)
