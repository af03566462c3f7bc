"""Base and retry runs merged: the latest success counts, every attempt is kept in the record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ALIGNED = "aligned"


class UnknownParent(ValueError):
    """A retry names a parent that the base run does not have."""


def attempts(base: DataFrame, retries: list[tuple[str, DataFrame]], base_name: str) -> DataFrame:
    """All rows with ``run_order`` (0 for the base run), ``run_name`` and ``run_kind``, under the union of all columns."""
    def tagged(df: DataFrame, order: int, name: str, kind: str) -> DataFrame:
        return df.withColumns({"run_order": F.lit(order), "run_name": F.lit(name), "run_kind": F.lit(kind)})

    out = tagged(base, 0, base_name, "first_pass")
    for order, (name, df) in enumerate(retries, 1):
        out = out.unionByName(tagged(df, order, name, "retry"), allowMissingColumns=True)
    return out


def unknown_parents(runs: DataFrame, parent: str) -> DataFrame:
    """Parents that only retries have."""
    known = runs.where(F.col("run_order") == 0).select(parent).distinct()
    return runs.where(F.col("run_order") > 0).select(parent).distinct().join(known, parent, "left_anti")


def merged(runs: DataFrame, parent: str, status: str, strict: bool = False) -> DataFrame:
    """The row of each base parent that counts, with the story of its attempts.

    That is the last aligned retry, else the base row.  Within a run the last row of a parent by ``attempt_at`` counts, if
    there is such a column.  Retries of unknown parents are left out, or an error if ``strict``.
    """
    if strict and (bad := unknown_parents(runs, parent).first()) is not None:
        raise UnknownParent(str(bad[0]))
    order = ["run_order"] + [c for c in ("attempt_at",) if c in runs.columns]
    rank = F.struct(*order)
    counts = (F.col("run_order") == 0) | (F.col(status) == ALIGNED)
    story = runs.groupBy(parent).agg(
        F.max_by(F.struct(*runs.columns), F.when(counts, rank)).alias("chosen"),
        F.max_by(F.col(status), F.when(F.col("run_order") == 0, rank)).alias("base_status"),
        F.count_if(F.col("run_order") > 0).alias("retry_attempts"),
        F.max_by(F.col(status), rank).alias("latest_status"),
        F.max_by(F.col("run_name"), rank).alias("latest_run"),
        F.count_if(F.col("run_order") == 0).alias("in_base"),
    )
    return story.where(F.col("in_base") > 0).select(
        "chosen.*",
        F.col("chosen.run_kind").alias("final_source"),
        F.col("chosen.run_name").alias("final_run"),
        "base_status", "retry_attempts", "latest_status", "latest_run",
    )


def transitions(runs: DataFrame, parent: str, status: str) -> DataFrame:
    """How often an attempt's status followed the one before it: (previous, status, n)."""
    order = ["run_order"] + [c for c in ("attempt_at",) if c in runs.columns]
    steps = runs.withColumn("previous", F.lag(status).over(Window.partitionBy(parent).orderBy(*order)))
    return (
        steps.where(F.col("run_order") > 0)
        .groupBy(F.coalesce("previous", F.lit("")).alias("previous"), F.col(status).alias("status"))
        .agg(F.count("*").alias("n"))
    )


def replacements(runs: DataFrame, status: str, run_names: list[str] | None = None) -> DataFrame:
    """(run_name, replacements): aligned rows of each retry; runs without any are listed if ``run_names`` names them."""
    found = runs.where(F.col("run_order") > 0).groupBy("run_name").agg(F.count_if(F.col(status) == ALIGNED).alias("replacements"))
    if run_names is None:
        return found
    names = runs.sparkSession.createDataFrame([(n,) for n in run_names], "run_name string")
    return names.join(found, "run_name", "left").select("run_name", F.coalesce("replacements", F.lit(0)).alias("replacements"))


def recovered(merged_parents: DataFrame, status: str) -> DataFrame:
    """One row: parents that the base run failed and a retry aligned."""
    return merged_parents.agg(F.count_if((F.col("base_status") != ALIGNED) & (F.col(status) == ALIGNED)).alias("recovered"))


def rows_of_chosen_run(children: DataFrame, merged_parents: DataFrame, parent: str) -> DataFrame:
    """The child rows (panels, raw predictions) that belong to the run which counts for their parent."""
    chosen = merged_parents.select(parent, F.col("final_run").alias("run_name"))
    return children.join(chosen, [parent, "run_name"], "left_semi")


def with_status(runs: DataFrame, parent: str, status: str, wanted: list[str]) -> DataFrame:
    """Distinct parents whose status is one of ``wanted``."""
    if not wanted:
        raise ValueError("no status given")
    return runs.where(F.col(status).isin(*wanted)).select(parent).distinct()


def retry_candidates(parents: DataFrame, columns: list[str], status: str = "status") -> DataFrame:
    """The parents of a run, resumed parts included, whose generation was cut off, with what a second try needs to know."""
    return parents.where(F.col(status) == "generation_truncated").select(*columns)
