"""Writing: fixed schemas, row-count shards, routes, JSON lines, one-row summaries, and guards for repeated runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from figcurate.schemas import conform
from figcurate.sources.files import Files

ROWS_PER_FILE = 10_000


def write_table(df: DataFrame, path: str, schema: T.StructType | None = None, rows_per_file: int = ROWS_PER_FILE, mode: str = "overwrite") -> None:
    """Parquet under a fixed schema in files of at most so many rows; an empty table is written too."""
    out = conform(df, schema) if schema is not None else df
    out.write.option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").mode(mode).parquet(path)


def write_routes(routes: dict[str, DataFrame], path: str, schema: T.StructType | None = None) -> None:
    """One table per route below a folder."""
    for name, df in routes.items():
        write_table(df, f"{path.rstrip('/')}/{name}", schema)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, key: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines by key, the last of equal keys in order of file and line; a missing folder is empty (with a schema)."""
    if not Files(spark, path).exists(""):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.json(path).withColumn("_at", F.struct(F.input_file_name(), F.monotonically_increasing_id()))
    named = rows.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    rest = [c for c in rows.columns if c not in (key, "_at")]
    return named.groupBy(key).agg(F.max_by(F.struct(*rest), "_at").alias("_last")).select(key, "_last.*")


def write_summary(df: DataFrame, path: str) -> dict:
    """The single row of an aggregate as an indented JSON file; returns it."""
    value = df.first().asDict(recursive=True)
    folder, _, name = path.rpartition("/")
    Files(df.sparkSession, folder or ".").replace(name, json.dumps(value, indent=2, ensure_ascii=False, default=str))
    return value


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The ``part-*.parquet`` files of a folder, else all Parquet files below it; FileNotFoundError if there are none."""
    files = Files(spark, path)
    if any(n.startswith("part-") and n.endswith(".parquet") for n in files.names("")):
        return spark.read.option("mergeSchema", True).option("pathGlobFilter", "part-*.parquet").parquet(path)
    if files.walk("", ".parquet"):
        return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)
    raise FileNotFoundError(f"no Parquet files under {path}")


class OtherSettings(ValueError):
    """Existing output was made with other settings."""


def check_settings(existing: DataFrame, **wanted: object) -> None:
    """Compare the settings that existing output records in its columns with those of this run."""
    names = [n for n in wanted if n in existing.columns]
    if not names:
        return
    for row in existing.select(*names).distinct().limit(2).collect():
        for name in names:
            if row[name] != wanted[name]:
                raise OtherSettings(f"{name}: {row[name]!r} in the output, {wanted[name]!r} wanted")


def same_settings(spark: SparkSession, path: str, **wanted: object) -> bool:
    """Whether a summary file exists and records the wanted settings."""
    folder, _, name = path.rpartition("/")
    files = Files(spark, folder or ".")
    found = json.loads(files.read(name)) if files.exists(name) else None
    return found is not None and all(found.get(k) == v for k, v in wanted.items())


def resume_mode(existing: list[bool], overwrite: bool = False, resume: bool = False) -> str:
    """What to do about the outputs of one shard, of which ``existing`` tells which are there: write, overwrite, skip, or an error.

    Only a whole set of outputs is skipped; part of one, or a whole one that nothing was said about, is an error.
    """
    if overwrite or not any(existing):
        return "overwrite" if any(existing) else "write"
    if all(existing) and resume:
        return "skip"
    raise FileExistsError("outputs of a shard exist" if all(existing) else "only some outputs of a shard exist")
