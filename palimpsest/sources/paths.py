"""Metadata operations on the session's file systems (list, rename, delete): no data passes here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm


def _path(spark: SparkSession, path: str):
    return _jvm(spark).org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def make_dirs(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    return sorted(s.getPath().toString() for s in _fs(spark, path).listStatus(_path(spark, path)))


def name_of(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename over an existing file: a reader sees the old or the new one, never neither.

    The old modification time is kept where the file system allows it, so a
    file source that compares times takes the file for the one it knows.
    """
    jvm = _jvm(spark)
    fs = _fs(spark, target)
    modified = fs.getFileStatus(_path(spark, target)).getModificationTime()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    src, dst = fs.makeQualified(_path(spark, source)), fs.makeQualified(_path(spark, target))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), conf).rename(src, dst, options)
    fs.setTimes(dst, modified, -1)


def move(spark: SparkSession, source: str, target: str) -> None:
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not move {source} to {target}")


def below(path: str, *parts: str) -> str:
    return "/".join([path.rstrip("/"), *parts])
