"""Run summaries as aggregates of one row, and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows and, by name, of rows for which a condition holds (null does not)."""
    return df.agg(F.count("*").alias("rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()))


def histogram(df: DataFrame, value: Column, skip_empty: bool = False) -> DataFrame:
    """(value, n), null counted as empty."""
    named = df.select(F.coalesce(value.cast("string"), F.lit("")).alias("value"))
    named = named.where(F.col("value") != "") if skip_empty else named
    return named.groupBy("value").agg(F.count("*").alias("n"))


def histogram_map(df: DataFrame, value: Column) -> DataFrame:
    """One row with the histogram as a map sorted by value; for columns with few values."""
    pairs = F.array_sort(F.collect_list(F.struct("value", "n")))
    return histogram(df, value).agg(F.map_from_entries(pairs).alias("histogram"))


def distinct_names(df: DataFrame, column: str, missing: str = "unrecorded") -> DataFrame:
    """One row with the sorted distinct values of a column, empty ones named ``missing``; the column may be absent."""
    value = F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(missing)) if column in df.columns else F.lit(missing)
    return df.agg(F.array_sort(F.collect_set(value)).alias("names"))


def last_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("last"))
    return picked.select(*key, "last.*")


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("first"))
    return picked.select(*key, "first.*")


def first_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first ``n`` rows of a total order; all rows without ``n``."""
    return df if n is None else df.orderBy(*order).limit(n)
