"""Queries of the general data problems (1 and 2) with their SQL."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figcurate.operators import compaction, incremental
from figcurate.session import ensure_checkpoint_dir, shared_checkpoint


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, ledger, runs = (table(spark, sf_dir, t) for t in ("singlepanel_records", "run_ledger", "pipeline_runs"))
    return incremental.unhandled(records, ledger, runs)


def p1_work_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, ledger, runs = (table(spark, sf_dir, t) for t in ("singlepanel_records", "run_ledger", "pipeline_runs"))
    return incremental.work_items(records, ledger, runs).withColumn("token", F.col("token").cast("bigint"))


def p1_ledger_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a work ledger over the records as they land: one that succeeds, one that dies, its successor, and its late return.

    The first run sees what landed in the first half of the time, the others everything.  Each figure's versions come out once,
    under the token of the run whose output counts.
    """
    records = table(spark, sf_dir, "singlepanel_records")
    ends = records.agg(*(f("landed_at").cast("timestamp").alias(n) for n, f in (("a", F.min), ("b", F.max))))
    middle = ends.select(F.expr("timestamp_micros((unix_micros(a) + unix_micros(b)) div 2)")).scalar()
    early = records.where(F.col("landed_at").cast("timestamp") <= middle)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    book, output = incremental.WorkLedger(spark, f"{folder}/book", ["pmcid", "figure_id"]), f"{folder}/output"
    items = incremental.current_figures(records)

    def handle(rows: DataFrame) -> DataFrame:
        return rows.withColumn("figure", F.concat_ws("/", "pmcid", "figure_id"))

    book.process_landed(early, incremental.current_figures, "first", handle, output, 60, now=0)
    lost, taken = book.claim_landed(records, incremental.current_figures, "dies", 60, now=100)
    handle(taken).write.mode("overwrite").parquet(book.output_path(output, lost))
    book.process_landed(records, incremental.current_figures, "next", handle, output, 60, now=200)
    with contextlib.suppress(incremental.StaleToken):
        book.complete(lost, taken, now=201)
    book.compact(items, now=300)
    book.process_landed(records, incremental.current_figures, "again", handle, output, 60, now=301)
    return book.results(items, output).select("pmcid", "figure_id", "version", "figure", "token")


def _small(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, stores = table(spark, sf_dir, "stored_files"), table(spark, sf_dir, "store_targets")
    single = table(spark, sf_dir, "singlepanel_records")
    panels = table(spark, sf_dir, "subfigure_records")
    named = compaction.named_places(single, "local_image_path", "singlepanel", stores).unionByName(
        compaction.named_places(panels, "local_panel_path", "subfigure", stores)
    )
    return compaction.small_files(files, stores, named)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small(spark, sf_dir).select("file_id")


def p2_consolidation_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.consolidation_plan(_small(spark, sf_dir))


def p2_plan_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = shared_checkpoint(_small(spark, sf_dir))
    return compaction.plan_faults(small, shared_checkpoint(compaction.consolidation_plan(small)))


def p2_crowded_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.crowded_partitions(_small(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_work_states": p1_work_states,
    "p1_ledger_runs": p1_ledger_runs,
    "p2_found": p2_found,
    "p2_crowded_partitions": p2_crowded_partitions,
    "p2_consolidation_plan": p2_consolidation_plan,
    "p2_plan_faults": p2_plan_faults,
}

_PMCID = "CASE WHEN regexp_extract({0}, '[0-9]+') <> '' THEN 'PMC' || regexp_extract({0}, '[0-9]+') END"
_VERSION = "TRY_CAST(regexp_extract({0}, '(?:^|\\.)\\s*([0-9]+)\\s*$', 1) AS BIGINT)"

_FIGURES = f"""
figures AS (
  SELECT pmcid, figure_id, max(version) AS version FROM (
    SELECT {_PMCID.format("pmcid")} AS pmcid, nullif(trim(figure_id), '') AS figure_id,
           {_VERSION.format("coalesce(nullif(trim(resolved_article_version), ''), article_version)")} AS version
    FROM singlepanel_records)
  WHERE pmcid IS NOT NULL AND figure_id IS NOT NULL
  GROUP BY pmcid, figure_id),
handled AS (
  SELECT {_PMCID.format("l.pmcid")} AS pmcid, nullif(trim(l.figure_id), '') AS figure_id,
         {_VERSION.format("l.processed_version")} AS version,
         bool_or(r.run_status = 'succeeded') AS succeeded,
         bool_or(r.run_status = 'running' AND r.run_started_at + INTERVAL 24 HOUR >= c.clock) AS held,
         max(l.run_id) AS token
  FROM run_ledger l JOIN pipeline_runs r ON r.run_id = l.run_id,
       (SELECT max(greatest(run_started_at, coalesce(run_ended_at, run_started_at))) AS clock FROM pipeline_runs) c
  GROUP BY 1, 2, 3),
items AS (
  SELECT f.pmcid, f.figure_id, f.version,
         CASE WHEN h.succeeded THEN 'done' WHEN h.held THEN 'leased' ELSE 'pending' END AS state, h.token
  FROM figures f LEFT JOIN handled h ON h.pmcid = f.pmcid AND h.figure_id = f.figure_id AND h.version = f.version)
"""


def _place(path: str) -> str:
    """Paths with their root in front: prefix, escapes and doubled, single-dot and one level of double-dot segments."""
    bare = f"regexp_replace(url_decode(replace({path}, '+', '%2B')), '^file:/+', '/')"
    full = f"CASE WHEN starts_with({bare}, '/') THEN {bare} ELSE t.root_dir || '/' || {bare} END"
    dots = f"regexp_replace(regexp_replace({full}, '/\\.(?=/)', '', 'g'), '//+', '/', 'g')"
    dots = f"regexp_replace(regexp_replace(regexp_replace({full}, '//+', '/', 'g'), '(/\\.)+/', '/', 'g'), '/[^/]+/\\.\\./', '/', 'g')"
    return f"CASE WHEN trim({path}) <> '' THEN {dots} END"


_SMALL = f"""
places AS (
  SELECT s.store_name, {_place("s.stored_path")} AS place, s.file_id, s.n_bytes, t.small_below_bytes
  FROM stored_files s JOIN store_targets t ON t.store_name = s.store_name),
files AS (
  SELECT store_name, place, min(file_id) AS file_id, max(n_bytes) AS n_bytes, min(small_below_bytes) AS small_below_bytes
  FROM places WHERE place IS NOT NULL GROUP BY 1, 2),
named AS (
  SELECT t.store_name, {_place("r.local_image_path")} AS place
  FROM singlepanel_records r, store_targets t WHERE t.store_name = 'singlepanel'
  UNION
  SELECT t.store_name, {_place("r.local_panel_path")} AS place
  FROM subfigure_records r, store_targets t WHERE t.store_name = 'subfigure')
"""

SQL: dict[str, str] = {
    "p1_found": f"WITH {_FIGURES} SELECT pmcid, figure_id FROM items WHERE state <> 'done'",
    "p1_work_states": f"WITH {_FIGURES} SELECT pmcid, figure_id, version, state, token FROM items",
    "p1_ledger_runs": f"""WITH rows_ AS (
      SELECT {_PMCID.format("pmcid")} AS pmcid, nullif(trim(figure_id), '') AS figure_id, landed_at,
             {_VERSION.format("coalesce(nullif(trim(resolved_article_version), ''), article_version)")} AS version FROM singlepanel_records),
    half AS (SELECT make_timestamp((epoch_us(min(landed_at)) + epoch_us(max(landed_at))) // 2) AS at FROM singlepanel_records),
    early AS (SELECT pmcid, figure_id, max(version) AS version FROM rows_, half WHERE landed_at <= half.at GROUP BY 1, 2),
    whole AS (SELECT pmcid, figure_id, max(version) AS version FROM rows_ GROUP BY 1, 2),
    runs AS (SELECT *, 1 AS token FROM early UNION ALL SELECT *, 3 AS token FROM (SELECT * FROM whole EXCEPT SELECT * FROM early))
    SELECT pmcid, figure_id, version, pmcid || '/' || figure_id AS figure, CAST(token AS BIGINT) AS token FROM runs
    WHERE pmcid IS NOT NULL AND figure_id IS NOT NULL""",
    "p2_found": f"""WITH {_SMALL}
      SELECT f.file_id FROM files f WHERE f.n_bytes > 0 AND f.n_bytes < f.small_below_bytes
      AND EXISTS (SELECT 1 FROM named n WHERE n.store_name = f.store_name AND n.place = f.place)""",
    "p2_crowded_partitions": f"""WITH {_SMALL}, small AS (SELECT f.* FROM files f WHERE f.n_bytes > 0 AND f.n_bytes < f.small_below_bytes
      AND EXISTS (SELECT 1 FROM named n WHERE n.store_name = f.store_name AND n.place = f.place))
      SELECT store_name, regexp_extract(place, '^(.*)/[^/]*$', 1) AS partition, count(*) AS small_files, CAST(sum(n_bytes) AS BIGINT) AS small_bytes
      FROM small GROUP BY 1, 2 HAVING count(*) > 8""",
    "p2_plan_faults": f"""WITH {_SMALL}
      SELECT f.store_name, count(*) AS files, CAST(sum(n_bytes) AS BIGINT) AS bytes, 0::BIGINT AS missing, 0::BIGINT AS twice, 0::BIGINT AS gaps,
        0::BIGINT AS off_size FROM files f WHERE f.n_bytes > 0 AND f.n_bytes < f.small_below_bytes
      AND EXISTS (SELECT 1 FROM named n WHERE n.store_name = f.store_name AND n.place = f.place) GROUP BY 1""",
}
