"""Predictions of a caption model joined to the panels they describe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figcurate.functions import text

ALIGNED = "aligned"


def judged(parents: DataFrame, prediction: str, expected: str, finish_reason: str) -> DataFrame:
    """``parents`` with ``parts``, ``predicted_count``, ``status`` and ``error`` of their prediction."""
    parts = text.subcaptions(F.col(prediction))
    rated = parents.withColumn("parts", parts).withColumn(
        "status", text.prediction_status(F.col("parts"), F.col(expected), F.col(finish_reason))
    )
    error = (
        F.when(F.col("status") == "generation_truncated", F.lit("Generation reached the token limit"))
        .when(F.col("status") == "empty_prediction", F.lit("Model returned no subcaptions"))
        .when(
            F.col("status") == "count_mismatch",
            F.format_string("Expected %s subcaptions but parsed %s", F.col(expected).cast("string"), F.size("parts").cast("string")),
        )
        .when(F.col("status") == "empty_subcaption", F.lit("One or more subcaptions are empty"))
        .otherwise(F.lit(""))
    )
    return rated.withColumns({"predicted_count": F.size("parts").cast("bigint"), "error": error})


def panel_captions(judged_parents: DataFrame, panels: DataFrame, parent: list[str], index: str) -> DataFrame:
    """Aligned parents' panels, each with its part of the prediction; ``index`` counts from 0."""
    good = judged_parents.where(F.col("status") == ALIGNED).select(*parent, F.posexplode("parts").alias("_at", "subcaption"))
    keyed = panels.withColumn("_at", F.col(index).cast("int"))
    return keyed.join(good, [*parent, "_at"]).drop("_at")


def matching(df: DataFrame, **wanted: object) -> DataFrame:
    """Rows whose columns equal the wanted values; null never does, except where null is wanted."""
    for name, value in wanted.items():
        df = df.where(F.col(name).eqNullSafe(F.lit(value)))
    return df


def parents_with_panels(parents: DataFrame, panels: DataFrame, parent: list[str], least: int = 1, most: int | None = None) -> DataFrame:
    """Parents whose number of panels lies in the range, with that number as ``n_panels``."""
    counts = panels.groupBy(*parent).agg(F.count("*").alias("n_panels"))
    fits = F.col("n_panels") >= least
    if most is not None:
        fits = fits & (F.col("n_panels") <= most)
    return parents.join(counts.where(fits), parent)


def without_files(df: DataFrame, path: str, files: DataFrame, file_path: str = "path") -> DataFrame:
    """Rows whose ``path`` is not in the listing (or null)."""
    listed = files.select(F.col(file_path).alias(path)).distinct()
    return df.join(listed, path, "left_anti")


def only_listed(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in ``keys``; an empty list keeps nothing."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def run_summary(parents: DataFrame, batch_key: list[str], seconds: Column, images: Column) -> DataFrame:
    """One row: parents, parts and images, seconds of distinct batches, and the rates; a rate without seconds is null."""
    per_batch = parents.groupBy(*batch_key).agg(F.max(seconds).alias("s"), F.max(images).alias("i"), F.count("*").alias("n"))
    totals = per_batch.agg(
        F.sum("n").alias("parents"), F.sum("i").cast("bigint").alias("images"), F.round(F.sum("s"), 6).alias("seconds"),
        F.count("*").alias("batches"),
    )
    return totals.select(
        "*",
        F.round(F.try_divide("parents", "seconds"), 6).alias("parents_per_second"),
        F.round(F.try_divide("images", "seconds"), 6).alias("images_per_second"),
    )
