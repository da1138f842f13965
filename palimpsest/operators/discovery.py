"""Propose which JSON paths hold personal data, with a score for human review."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import json_leaves

# Patterns valid in Java and RE2 alike.
DETECTORS: dict[str, str] = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"^\+[0-9][0-9 ().-]{6,}[0-9]$",
    "url_person": r"[?&](firstName|lastName|email)=[^&#]+",
    "person_name": r"^[A-Z][a-z]+ [A-Z][a-z]+$",
}


def path_profile(df: DataFrame, column: str, detectors: Mapping[str, str] = DETECTORS) -> DataFrame:
    """Per leaf path: values, distinct values, and hits of each detector, in one scan of the documents."""
    return json_leaves.profile(df, column, detectors)


def propose_paths(
    profile: DataFrame, detectors: Mapping[str, str] = DETECTORS, threshold: float = 0.5
) -> DataFrame:
    """Paths whose best detector hits at least ``threshold`` of the values: ``path, pii_type, score``."""
    scored = F.array(
        *[
            F.struct(
                F.round(F.col(f"{n}_hits") / F.col("values"), 4).alias("score"), F.lit(n).alias("pii_type")
            )
            for n in detectors
        ]
    )
    best = F.array_max(scored)
    return profile.select("path", best.alias("b")).select("path", "b.pii_type", "b.score").where(
        F.col("score") >= threshold
    )
