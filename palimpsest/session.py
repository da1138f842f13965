"""Session defaults, the shared scratch folder, and size-checked broadcasts."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

BROADCAST_BYTES_CONF = "palimpsest.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
#: A side takes two to three times its measured bytes in the driver, and a query has several.
HEAP_SHARE = 16
#: Shuffle files go when the query that made them ends: what was written stands for them.
DROP_SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: dict[str, list[str]] = {}
_releases: dict[str, int] = {}


def get_session(app: str = "palimpsest", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution on and timestamps pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Python workers find this package, whatever folder they start in."""
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    named = spark.sparkContext.environment
    known = named.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if home not in known.split(os.pathsep):
        named["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a folder in the warehouse, which executors share too.  A
    cluster whose warehouse is a plain local path has no shared folder: an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
    if not local and ("://" not in warehouse and not warehouse.startswith("hdfs:") or warehouse.startswith("file:")):
        raise ValueError("on a cluster, name a shared folder in spark.checkpoint.dir")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path (not created yet) below the scratch root."""
    path = f"{scratch_root(spark)}/palimpsest/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete every scratch path this application made.

    Scratch tables may hold the very values an erasure removed, so a run ends
    with this call; frames that still read them are unusable afterwards.
    """
    from palimpsest.sources import paths

    app = spark.sparkContext.applicationId
    _releases[app] = _releases.get(app, 0) + 1
    made = _made.pop(app, [])
    return sum(paths.delete(spark, path) for path in made)


def scratch_epoch(spark: SparkSession) -> tuple[str, int]:
    """Changes whenever the scratch tables made so far are gone."""
    app = spark.sparkContext.applicationId
    return app, _releases.get(app, 0)


def written(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Cut lineage through a parquet table in the scratch folder and read it back.

    ``rows_per_file`` bounds the files, so that what one task wrote is read by many.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    before = spark.conf.get(DROP_SHUFFLES_CONF)
    spark.conf.set(DROP_SHUFFLES_CONF, "true")
    try:
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    finally:
        spark.conf.set(DROP_SHUFFLES_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the scratch tables a frame of ``written`` reads, once nothing is left that reads them."""
    from palimpsest.sources import paths

    spark = df.sparkSession
    mine = f"{scratch_root(spark)}/palimpsest/{spark.sparkContext.applicationId}/"
    made = _made.get(spark.sparkContext.applicationId, [])
    names = {name.rsplit("/", 2)[1] for name in df.inputFiles()}
    for path in [path for path in made if path.startswith(mine) and path.rsplit("/", 1)[1] in names]:
        paths.delete(spark, path)
        made.remove(path)


def _cell_bytes(value, kind):
    """Bytes a value takes in a row; collections by their elements."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(16)
    if isinstance(kind, StructType):
        return sum((_cell_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(16))
    if isinstance(kind, ArrayType):
        each = F.aggregate(value, F.lit(0).cast("long"), lambda total, x: total + _cell_bytes(x, kind.elementType).cast("long"))
        return F.coalesce(each, F.lit(0).cast("long")) + F.lit(24)
    if isinstance(kind, MapType):
        return _cell_bytes(F.map_keys(value), ArrayType(kind.keyType)) + _cell_bytes(F.map_values(value), ArrayType(kind.valueType))
    return F.lit(16)


def _row_bytes(df: DataFrame):
    return sum((_cell_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: one distributed aggregate."""
    return int(df.agg(F.sum(_row_bytes(df)).alias("bytes")).first()["bytes"] or 0)


def broadcast_limit(spark: SparkSession) -> int:
    """The limit that is set, or else what the driver can hold several of: it gathers each side, hashes it and cuts it into blocks."""
    named = spark.conf.get(BROADCAST_BYTES_CONF, None)
    if named is not None:
        return int(named)
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return min(DEFAULT_BROADCAST_BYTES, heap // HEAP_SHARE)


def fits_broadcast(df: DataFrame) -> bool:
    """Measure the side (one distributed aggregate) against the broadcast limit."""
    return measured_bytes(df) <= broadcast_limit(df.sparkSession)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast hint when the measured size allows it; otherwise a plain (shuffled) join side."""
    return F.broadcast(df) if fits_broadcast(df) else df


def inline_table(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A few constant rows as a relation the optimizer knows to be small."""
    if not rows:
        raise ValueError("an inline table needs at least one row")
    columns = [name.strip() for name in names.split(",")]
    cells = [
        F.struct(*[F.lit(value).alias(column) for column, value in zip(columns, row, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))
