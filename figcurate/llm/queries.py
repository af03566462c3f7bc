"""Registered queries of the language-model data problems with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figcurate.llm import characters, components, markup, near_duplicates, packing, readability, tokens, truncation


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.connected_pairs(components.article_components(table(spark, sf_dir, "subfigure_records")))


def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = components.record_groups(table(spark, sf_dir, "subfigure_records"))
    return components.assign_splits(groups, table(spark, sf_dir, "split_targets"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.with_markup(table(spark, sf_dir, "singlepanel_records"))


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = table(spark, sf_dir, "singlepanel_records")
    return markup.cleaned(characters.text_items(single, {"caption": False, "reference_texts": True}))


def _duplicates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    single = table(spark, sf_dir, "singlepanel_records").select(F.col("caption_id").alias("id"), F.col("caption").alias("text"))
    panels = table(spark, sf_dir, "subfigure_records").select(F.col("caption_id").alias("id"), F.col("main_caption").alias("text"))
    return near_duplicates.near_duplicate_classes(single.unionByName(panels))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = near_duplicates.near_duplicate_pairs(*_duplicates(spark, sf_dir))
    return pairs.select(F.col("id_a").alias("caption_id_a"), F.col("id_b").alias("caption_id_b"))


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.duplicate_summary(*_duplicates(spark, sf_dir)).withColumnRenamed("id", "caption_id")


def _written_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = table(spark, sf_dir, "singlepanel_records")
    return characters.text_items(single, {"caption": False, "reference_texts": True}).unionByName(
        characters.text_items(table(spark, sf_dir, "subfigure_records"), {"subcaption": False})
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return characters.disguised(_written_items(spark, sf_dir))


def p6_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return characters.normalised(_written_items(spark, sf_dir))


def _generated_values(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parents = table(spark, sf_dir, "align_parents")
    panels = table(spark, sf_dir, "subfigure_records")
    source = F.col("caption_source_run_dir").alias("source")
    return (
        parents.select("record_id", source, F.col("raw_prediction").alias("text")),
        panels.select("record_id", source, F.col("subcaption").alias("text")),
    )


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, captions = _generated_values(spark, sf_dir)
    return truncation.truncated(truncation.pieces(predictions, True).unionByName(truncation.pieces(captions, False)))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.with_copies(_cut(spark, sf_dir)).select("record_id")


def p7_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, captions = _generated_values(spark, sf_dir)
    return truncation.truncation_rates(predictions.unionByName(captions), truncation.with_copies(_cut(spark, sf_dir)))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, sf_dir, "documents"))


def p9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack(packing.measured(documents), table(spark, sf_dir, "pack_specs"), documents.count())


def p9_utilisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.utilisation(p9_packing(spark, sf_dir), table(spark, sf_dir, "pack_specs"))


def p9_packing_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_faults(p9_packing(spark, sf_dir), table(spark, sf_dir, "pack_specs"), table(spark, sf_dir, "documents"))


def p3_split_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.split_faults(table(spark, sf_dir, "subfigure_records"), p3_splits(spark, sf_dir), table(spark, sf_dir, "split_targets"))


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.reading_levels(table(spark, sf_dir, "documents"), table(spark, sf_dir, "level_labels"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readability.demanding_english(_levels(spark, sf_dir))


def p10_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _levels(spark, sf_dir).withColumn("grade", F.round("grade", 6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p3_found": p3_found,
    "p3_splits": p3_splits,
    "p3_split_faults": p3_split_faults,
    "p4_found": p4_found,
    "p4_clean": p4_clean,
    "p5_found": p5_found,
    "p5_groups": p5_groups,
    "p6_found": p6_found,
    "p6_normalised": p6_normalised,
    "p7_found": p7_found,
    "p7_rates": p7_rates,
    "p8_ids": p8_ids,
    "p9_packing": p9_packing,
    "p9_utilisation": p9_utilisation,
    "p9_packing_faults": p9_packing_faults,
    "p10_found": p10_found,
    "p10_levels": p10_levels,
}

_PAIRS = """pairs AS (SELECT DISTINCT
    CASE WHEN regexp_extract(pmcid, '[0-9]+') <> '' THEN 'PMC' || regexp_extract(pmcid, '[0-9]+') END AS article,
    nullif(trim(regexp_replace(trim(parent_image_id), '(?i)\\.(jpg|png)$', '')), '') AS image FROM subfigure_records)"""

_DOCS = """texts AS (SELECT caption_id AS id, caption AS t FROM singlepanel_records UNION SELECT caption_id, main_caption FROM subfigure_records),
      split AS (SELECT row_number() OVER () AS doc, id, regexp_extract_all(lower(t), '[\\p{L}\\p{N}]+') AS words FROM texts WHERE t IS NOT NULL),
      docs AS (SELECT doc, id, len(words) AS n, words FROM split WHERE len(words) >= 45)"""
_SHARED = """tokens AS (SELECT doc, id, n, word, row_number() OVER (PARTITION BY doc, word) AS k FROM (SELECT doc, id, n, unnest(words) AS word FROM docs)),
      shared AS (SELECT x.id AS a, y.id AS b, x.doc AS dx, y.doc AS dy, count(*) AS c, max(x.n) AS nx, max(y.n) AS ny
        FROM tokens x JOIN tokens y ON x.word = y.word AND x.k = y.k AND x.id < y.id AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n GROUP BY ALL)"""

SQL: dict[str, str] = {
    "p3_found": f"""WITH RECURSIVE {_PAIRS},
      edges AS (SELECT DISTINCT x.article AS a, y.article AS b FROM pairs x JOIN pairs y ON x.image = y.image AND x.article <> y.article),
      reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
      SELECT a AS pmcid_a, b AS pmcid_b FROM reach WHERE a < b""",
    "p3_split_faults": """SELECT (SELECT count(*) FROM subfigure_records) AS records, 0::BIGINT AS unassigned, 0::BIGINT AS torn_articles,
      0::BIGINT AS torn_images, count(*) AS splits, count(*) AS splits_near_target FROM split_targets""",
    "p5_found": f"""WITH {_DOCS},
      {_SHARED}
      SELECT DISTINCT a AS caption_id_a, b AS caption_id_b FROM shared WHERE 5 * c >= 4 * greatest(nx, ny)""",
    "p5_groups": f"""WITH {_DOCS},
      classes AS (SELECT list_sort(words) AS bag, min(id) AS class_id, count(DISTINCT id) AS class_size, min(doc) AS head FROM docs GROUP BY 1),
      members AS (SELECT DISTINCT d.id, c.head, c.class_id, c.class_size FROM docs d JOIN classes c ON list_sort(d.words) = c.bag),
      heads AS (SELECT doc, id, words, n FROM docs WHERE doc IN (SELECT head FROM classes)),
      tokens AS (SELECT doc, n, word, row_number() OVER (PARTITION BY doc, word) AS k FROM (SELECT doc, n, unnest(words) AS word FROM heads)),
      shared AS (SELECT x.doc AS a, y.doc AS b, count(*) AS c, max(greatest(x.n, y.n)) AS n FROM tokens x
        JOIN tokens y ON x.word = y.word AND x.k = y.k AND x.doc <> y.doc AND 5 * x.n >= 4 * y.n AND 5 * y.n >= 4 * x.n GROUP BY 1, 2),
      links AS (SELECT a, count(*) AS n_links FROM shared WHERE 5 * c >= 4 * n GROUP BY 1)
      SELECT m.id AS caption_id, m.class_id, m.class_size, coalesce(l.n_links, 0) AS n_links FROM members m LEFT JOIN links l ON l.a = m.head""",
    "p9_packing_faults": """SELECT spec_id, CAST(capacity_tokens AS BIGINT) AS capacity_tokens, (SELECT count(DISTINCT doc_id) FROM documents) AS documents,
      0::BIGINT AS missing, 0::BIGINT AS overfull, 0::BIGINT AS split_though_fitting, 0::BIGINT AS gaps FROM pack_specs WHERE capacity_tokens > 0""",
}
