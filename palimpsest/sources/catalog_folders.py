"""Targets by name: ``catalog.schema`` as folders of tables, with their registry and queue beside them.

``<root>/<catalog>/<schema>/<table>`` holds a table's parquet files, ``_registry`` and
``_requests`` in the same folder what drives the erasure.  Metadata only passes here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from palimpsest.operators.erasure import Target, parse_targets
from palimpsest.sources import paths
from palimpsest.sources.rewrite import replace_table

REGISTRY, REQUESTS = "_registry", "_requests"


@dataclass(frozen=True)
class FolderCatalog:
    spark: SparkSession
    root: str

    def folder(self, target: str, *below: str) -> str:
        return paths.below(self.root, *target.split("."), *below)

    def _maybe(self, target: str, name: str) -> DataFrame | None:
        path = self.folder(target, name)
        return self.spark.read.parquet(path) if paths.exists(self.spark, path) else None

    def target(self, name: str) -> Target:
        """The tables there are, the registry and the queue; a schema that is not there has none of them."""
        found = [paths.name_of(p) for p in paths.children(self.spark, self.folder(name))]
        tables = {t: self.spark.read.parquet(self.folder(name, t)) for t in found if not t.startswith("_")}
        return Target(name, tables, self._maybe(name, REGISTRY), self._maybe(name, REQUESTS))

    def targets(self, text: str | None, default: str) -> list[Target]:
        """The targets a text names, each once, in its order."""
        return [self.target(name) for name in parse_targets(text, default)]

    def publish(self, target: str, table: str, erased: DataFrame) -> DataFrame:
        """Replace a target's table by its erased version."""
        return replace_table(erased, self.folder(target, table))
