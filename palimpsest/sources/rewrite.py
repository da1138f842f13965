"""Change records inside existing files, and replace whole tables.

There is no row-level DML on plain files.  Two ways are offered:

* ``rewrite_files``: only files that hold an affected row are read, changed, and
  put back *under the same path*.  A file stream remembers paths, so it does not
  read them again; files without an affected row are not opened for writing.
* ``replace_table``: write the new version beside the old one and swap.

In both, readers of the old bytes are gone afterwards: the old files are
overwritten or deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.functions.json_spans import redact_lines
from palimpsest.functions.masking import ERASED_TOKEN, PROFILE_ERASURE_POLICY, mask_expr
from palimpsest.operators import matching
from palimpsest.operators.erasure import apply_erasure, erase_layer
from palimpsest.operators.matching import DELETE_CODE, MODE, OBFUSCATE_CODE
from palimpsest.operators.registry import TableRules
from palimpsest.operators.row_address import ROW, marked
from palimpsest.session import broadcast_if_small, scratch_dir, written
from palimpsest.sources import paths
from palimpsest.sources.file_index import FILES_PER_WAVE, FileIndex, waves

RENAME_THREADS = 16
_FILE = "_file"
_SLOT = "_slot"


def _slot_of(path: str) -> str:
    return hashlib.sha1(path.encode("utf-8")).hexdigest()


def affected_files(records: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Distinct files with a row whose ``on`` is among ``keys``."""
    return (
        records.select(F.col(on), F.col("_metadata.file_path").alias(_FILE))
        .join(broadcast_if_small(keys.select(on).distinct()), on, "left_semi")
        .select(_FILE)
        .distinct()
    )


def _put_back(spark: SparkSession, staging: str, uri: str) -> str:
    """Replace one source file by its staged version, or delete it if nothing was left of it."""
    path = unquote(uri)
    folder = paths.below(staging, f"{_SLOT}={_slot_of(uri)}")
    parts = [p for p in paths.children(spark, folder) if paths.name_of(p).startswith("part-")]
    if len(parts) > 1:
        raise RuntimeError(f"{path} was staged as {len(parts)} files")
    if not parts:
        paths.delete(spark, path)
        return "removed"
    paths.replace(spark, parts[0], path)
    return "rewritten"


def rewrite_files(
    spark: SparkSession,
    files: DataFrame,
    read: Callable[[list[str]], DataFrame],
    change: Callable[[DataFrame], DataFrame],
    fmt: str,
    wave_size: int = FILES_PER_WAVE,
) -> dict[str, int]:
    """Apply ``change`` to each file and put the result back under its path.

    ``change`` gets the rows with their file path and may drop or alter rows.
    Each file is one shuffle key and is written by one task as a stream, so a
    task holds no more than its sort buffer.  Results are staged outside the
    source folder; a file is replaced by an atomic rename, an emptied one
    deleted.  A run that dies half way can simply be run again.
    """
    done = {"rewritten": 0, "removed": 0}
    for wave in waves(files, wave_size):
        staging = scratch_dir(spark, "staging")
        rows = read([unquote(uri) for uri in wave]).withColumn(_FILE, F.col("_metadata.file_path"))
        changed = change(rows).withColumn(_SLOT, F.sha1(_FILE)).drop(_FILE)
        changed.repartition(len(wave), _SLOT).write.partitionBy(_SLOT).format(fmt).save(staging)
        with ThreadPoolExecutor(RENAME_THREADS) as pool:
            for outcome in pool.map(lambda uri: _put_back(spark, staging, uri), wave):
                done[outcome] += 1
        paths.delete(spark, staging)
    return done


# --- JSON source files -------------------------------------------------------------


def redact_json_line(line, token: str = ERASED_TOKEN):
    """One JSON record as text, redacted and written anew: unknown fields and their order are kept.

    ``email`` and ``full_name`` become the token where present; ``profile_json``
    is masked as text when it is a string and left alone otherwise.  For records
    whose text ``json_spans`` cannot walk.
    """
    mark = F.lit(token).cast("variant")

    def field(name, value):
        masked = mask_expr(value.cast("string"), PROFILE_ERASURE_POLICY, token=token)
        is_text = F.schema_of_variant(value) == "STRING"
        return (
            F.when(name.isin("email", "full_name"), mark)
            .when((name == "profile_json") & is_text, masked.cast("variant"))
            .otherwise(value)
        )

    record = F.from_json(line, "map<string,variant>")
    return F.to_json(F.transform_values(record, field), {"ignoreNullFields": "false"})


def _lines(spark: SparkSession, where: str | list[str]) -> DataFrame:
    # a line ends at its line feed: what else stands before it belongs to the line
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("lineSep", "\n")
    return reader.text(where)


def _filled():
    return F.col("value").rlike(r"\S")


def _unreadable():
    # a repeated key is no reason to stop: a variant would not take it
    return _filled() & F.get_json_object("value", "$").isNull()


def landing_index(spark: SparkSession, root: str, landing: str) -> FileIndex:
    """The index of the source files by user; it counts lines that are no JSON."""
    keys = {"user_id": F.get_json_object("value", "$.user_id")}
    return FileIndex(spark, root, landing, "*.json", lambda where: _lines(spark, where), keys, _unreadable())


def landing_files(
    spark: SparkSession, landing: str, modes: DataFrame, lines: DataFrame | None = None, broken: DataFrame | None = None
) -> DataFrame:
    """The source files that hold a line of the users in ``modes``; lines that are not JSON are an error.

    ``lines`` and ``broken`` come from an index: the lines of the files that may hold a
    user, and the files with lines that are not JSON.  Without them every file is read.
    """
    # a line whose owner cannot be read could hold anybody: nothing is rewritten until it is mended
    lines = _lines(spark, landing) if lines is None else lines
    broken = lines.where(_unreadable()).select("_metadata.file_path").distinct() if broken is None else broken
    where = [r[0] for r in broken.limit(5).collect()]
    if where:
        raise ValueError(f"landing lines that are not JSON, so that their owner is unknown, in {where} and perhaps more files")
    user = F.get_json_object("value", "$.user_id").alias("user_id")
    return affected_files(lines.select("_metadata", user), modes, "user_id")


def scrub_landing(
    spark: SparkSession,
    landing: str,
    modes: DataFrame,
    token: str = ERASED_TOKEN,
    lines: DataFrame | None = None,
    broken: DataFrame | None = None,
) -> dict[str, int]:
    """Erase users from the source files themselves, so that a full rebuild cannot bring them back.

    Lines of other users pass through as they are, byte for byte; redacted lines differ in
    nothing but the redacted values.  ``lines``, ``broken``: as for ``landing_files``.
    """
    files = landing_files(spark, landing, modes, lines, broken)

    def change(rows: DataFrame) -> DataFrame:
        side = broadcast_if_small(modes.select("user_id", MODE))
        flagged = rows.where(_filled()).withColumn(
            "user_id", F.get_json_object("value", "$.user_id")
        ).join(side, "user_id", "left")
        kept = flagged.where(F.coalesce(MODE, F.lit(0)) != DELETE_CODE)
        # lines of others are null here: they pass through without being looked at
        mine = F.when(F.col(MODE) == OBFUSCATE_CODE, F.col("value"))
        spans = redact_lines(mine, ("email", "full_name"), "profile_json", PROFILE_ERASURE_POLICY["keys"], token)
        again = F.when(mine.isNotNull(), redact_json_line(F.col("value"), token))
        return kept.withColumn("_new", spans).select(F.coalesce("_new", again, "value").alias("value"), _FILE)

    return rewrite_files(spark, files, lambda where: _lines(spark, where), change, "text")


# --- parquet layers ------------------------------------------------------------------


def layer_rows(spark: SparkSession, schema, where: str | list[str]) -> DataFrame:
    """The rows of a parquet layer, or of some of its files; none if no file is left."""
    reader = spark.read.schema(schema).option("pathGlobFilter", "*.parquet")
    return reader.option("recursiveFileLookup", "true").parquet(*([where] if isinstance(where, str) else where))


def layer_index(spark: SparkSession, root: str, layer: str, schema) -> FileIndex:
    """The index of a layer's files by user and by address."""
    keys = {"user_id": F.col("user_id"), "email": F.lower("email")}
    return FileIndex(spark, root, layer, "*.parquet", lambda where: layer_rows(spark, schema, where), keys)


def layer_files(spark: SparkSession, layer: str, schema, modes: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The files of a parquet layer that hold a row of the users in ``modes``; ``rows``: of the files that may."""
    return affected_files(layer_rows(spark, schema, layer) if rows is None else rows, modes, "user_id")


def erase_layer_files(
    spark: SparkSession, layer: str, schema, modes: DataFrame, token: str = ERASED_TOKEN, rows: DataFrame | None = None
) -> dict[str, int]:
    """Erase users from a parquet layer in place, file by file."""
    return rewrite_files(
        spark,
        layer_files(spark, layer, schema, modes, rows),
        lambda where: layer_rows(spark, schema, where),
        lambda df: erase_layer(df, modes, token),
        "parquet",
    )


# --- any parquet table, by row address ------------------------------------------------


def erase_files(
    spark: SparkSession,
    path: str,
    rules: TableRules,
    subjects: matching.Subjects,
    token: str = ERASED_TOKEN,
    rule: str = matching.EMAIL_FIRST,
    schema: StructType | None = None,
    **options,
) -> dict[str, int]:
    """Erase requests from a parquet table in place; files without a matched row stay as they are.

    One scan finds the matched rows by file and place in it; only their files are read
    again.  Counts of files: ``files`` of the table, ``rewritten``, ``removed`` (nothing left).
    A table of which nothing may be left needs its ``schema``: no file tells it any more.
    """
    if schema is None:
        schema = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    table = layer_rows(spark, schema, path)
    modes = written(matching.find(table, rules, subjects, (rule,), **options).modes(rule), "modes")

    def change(rows: DataFrame) -> DataFrame:
        placed = rows.select("*", F.col("_metadata.row_index").alias(ROW))
        return apply_erasure(marked(placed, modes), rules, token).drop(ROW)

    done = rewrite_files(spark, modes.select(_FILE).distinct(), lambda where: layer_rows(spark, schema, where), change, "parquet")
    return {"files": len(table.inputFiles()), **done}


# --- whole tables -----------------------------------------------------------------------


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write the new version beside the table, swap, and delete the old bytes.

    ``df`` may read the table itself: nothing is removed before the new version
    is complete.
    """
    spark = df.sparkSession
    fresh, old = f"{path}__new", f"{path}__old"
    paths.delete(spark, fresh)
    df.write.parquet(fresh)
    if paths.exists(spark, path):
        paths.delete(spark, old)
        paths.move(spark, path, old)
    paths.move(spark, fresh, path)
    paths.delete(spark, old)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(df.schema).parquet(path)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that died between its two renames."""
    fresh, old = f"{path}__new", f"{path}__old"
    if not paths.exists(spark, path):
        if paths.exists(spark, f"{fresh}/_SUCCESS"):
            paths.move(spark, fresh, path)
        elif paths.exists(spark, old):
            paths.move(spark, old, path)
    paths.delete(spark, fresh)
    paths.delete(spark, old)
