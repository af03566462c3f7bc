"""Queries that run whole stages over the record tables: parsing, acquisition, eligibility, alignment with retries, media of all deliveries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from figcurate.functions import ids
from figcurate.operators import alignment, candidates, compaction, panels, recovery, resolve
from figcurate.plans import pipelines
from figcurate.plans.curation_queries import _LIC, _UPPER, _basename, _rank, _stem
from figcurate.plans.data_queries import _PMCID, _VERSION, _place, table
from figcurate.sources import articles, jats

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__], SQL[query.__name__] = query, sql
        return query

    return add


# ------------------------------------------------------------------------------------------------ articles as XML

_WHITE = "\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
#: Characters that XML does not allow; they are left out on both sides.
_FORBIDDEN = "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"


def _tidy(x: str) -> str:
    allowed = f"regexp_replace(coalesce({x}, ''), '{_FORBIDDEN}', '', 'g')"
    return f"trim(regexp_replace({allowed}, '[{_WHITE}]+', ' ', 'g'))"


def _escaped(value: Column) -> Column:
    out = F.regexp_replace(F.coalesce(value, F.lit("")), _FORBIDDEN, "")
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(sign), F.lit(name))
    return out


def _article(name: str) -> Column:
    """An article of one figure, its references and a second figure without a caption, as XML."""
    each = lambda column, before, after: F.array_join(
        F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda x: F.concat(F.lit(before), _escaped(x), after)), ""
    )
    figure = _escaped(F.col("figure_id"))
    xref = F.concat(F.lit(' <xref ref-type="fig" rid="'), figure, F.lit('">here</xref></p>'))
    return F.concat(
        F.lit('<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><journal-meta><journal-title>'), _escaped(F.col("journal_title")),
        F.lit('</journal-title></journal-meta><article-meta><article-id pub-id-type="pmc">'), _escaped(F.col("pmcid")),
        F.lit('</article-id><article-id pub-id-type="pmid">'), _escaped(F.col("pmid").cast("string")), F.lit("</article-id><title-group><article-title>"),
        _escaped(F.col("article_title")), F.lit("</article-title></title-group><permissions><license><license-p>"), _escaped(F.col("license")),
        F.lit('</license-p></license></permissions></article-meta></front><body><fig id="'), figure, F.lit('"><label>'), _escaped(F.col("figure_label")),
        F.lit("</label><caption><p>"), _escaped(F.col("caption")), F.lit("</p></caption>"),
        each(F.col("image_hrefs"), '<graphic xlink:href="', F.lit('"/>')), F.lit("</fig>"), each(F.col("reference_texts"), "<p>", xref),
        F.lit('<fig id="no-caption"/></body></article>'),
    ).alias(name)


@register(
    f"""WITH r AS (SELECT record_id, license, {_UPPER.format("license")} AS u, * FROM singlepanel_records),
    p AS (SELECT CAST(record_id AS VARCHAR) AS source_xml, {_PMCID.format("pmcid")} AS pmcid, {_tidy("journal_title")} AS journal_title,
      {_tidy("article_title")} AS article_title, {_tidy("pmid")} AS pmid, coalesce({_LIC.format("license")}, '') AS license,
      {_tidy("figure_label")} AS figure_label, {_tidy("caption")} AS caption,
      coalesce(len(list_distinct(list_filter(image_hrefs, lambda x: coalesce(x, '') <> ''))), 0) AS n_hrefs,
      len(list_distinct(list_transform(coalesce(reference_texts, []), lambda x: {_tidy("x")} || ' here'))) AS n_references FROM r)
    SELECT source_xml, coalesce(pmcid, '') AS pmcid, journal_title, article_title, pmid, license, figure_label, caption, CAST(n_hrefs AS BIGINT) AS n_hrefs,
      CAST(n_references AS BIGINT) AS n_references FROM p WHERE caption <> ''"""
)
def parsed_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record written as an article and read back by the parser: ids, licence, label, caption, links and references."""
    rows = table(spark, sf_dir, "singlepanel_records")
    files = rows.select(F.col("record_id").cast("string").alias("path"), F.encode(_article("xml"), "UTF-8").alias("content"))
    return jats.parse_articles(files).select(
        "source_xml", "pmcid", "journal_title", "article_title", "pmid", "license", "figure_label", "caption",
        F.size("image_hrefs").cast("bigint").alias("n_hrefs"), F.size("reference_texts").cast("bigint").alias("n_references"),
    )


@register(
    f"""WITH r AS (SELECT {_PMCID.format("pmcid")} AS pmcid, {_VERSION.format("coalesce(nullif(trim(resolved_article_version), ''), article_version)")} AS version,
      license, coalesce(article_is_retracted, false) AS retracted FROM singlepanel_records),
    wanted AS (SELECT pmcid FROM r WHERE pmcid IS NOT NULL UNION SELECT {_PMCID.format("pmcid")} FROM subfigure_records WHERE regexp_matches(pmcid, '[0-9]')),
    latest AS (SELECT pmcid, max(version) AS version FROM r WHERE version IS NOT NULL GROUP BY 1),
    about AS (SELECT pmcid, version, min(license) AS license, bool_or(retracted) AS retracted FROM r GROUP BY 1, 2),
    j AS (SELECT w.pmcid, l.version, a.license, a.retracted, {_UPPER.format("a.license")} AS u FROM wanted w LEFT JOIN latest l ON l.pmcid = w.pmcid
      LEFT JOIN about a ON a.pmcid = l.pmcid AND a.version = l.version),
    k AS (SELECT pmcid, version, retracted, {_LIC.format("license")} AS license FROM j)
    SELECT pmcid, version, license, CASE WHEN version IS NULL THEN 'not_pmc_open_access' WHEN coalesce(retracted, false) THEN 'retracted'
      WHEN NOT coalesce(license IN ('CC BY', 'CC BY-NC', 'CC BY-NC-SA', 'CC0', 'CC BY-SA'), false) THEN 'license_not_allowed' ELSE 'downloaded' END AS status FROM k"""
)
def selected_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "singlepanel_records").select(
        ids.canonical_pmcid(F.col("pmcid")).alias("pmcid"), ids.current_version(F.col("resolved_article_version"), F.col("article_version")).alias("version"),
        "license", F.coalesce("article_is_retracted", F.lit(False)).alias("retracted"),
    )
    others = table(spark, sf_dir, "subfigure_records").select(ids.canonical_pmcid(F.col("pmcid")).alias("pmcid"))
    wanted = rows.select("pmcid").unionByName(others).where(F.col("pmcid").isNotNull())
    return articles.acquired(wanted, rows, rows)


# ------------------------------------------------------------------------------------------------ rules and counts


@register(
    """SELECT record_id, 'single_panel' AS source_type FROM singlepanel_records WHERE image_status = 'ready' AND detection_status = 'classified'
      AND is_multipanel = false AND coalesce(local_image_path, '') <> ''
    UNION ALL SELECT record_id, 'subfigure' FROM subfigure_records WHERE crop_status = 'ready' AND caption_alignment_status = 'aligned'
      AND coalesce(local_panel_path, '') <> '' AND trim(coalesce(subcaption, '')) <> ''"""
)
def eligible_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    single = table(spark, sf_dir, "singlepanel_records").where(candidates.single_panel_is_eligible())
    parts = table(spark, sf_dir, "subfigure_records").where(candidates.subfigure_is_eligible())
    return single.select("record_id", F.lit("single_panel").alias("source_type")).unionByName(parts.select("record_id", F.lit("subfigure").alias("source_type")))


@register(
    """WITH c AS (SELECT parent_image_id, count(*) AS n, count(*) FILTER (crop_status = 'ready') AS ok FROM subfigure_records GROUP BY 1)
    SELECT count(*) AS parents, count(*) FILTER (n = ok) AS separated, count(*) FILTER (n <> ok) AS failed, CAST(sum(n) AS BIGINT) AS panels,
      CAST(sum(ok) AS BIGINT) AS ready_panels FROM c"""
)
def separation_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.separation_counters(table(spark, sf_dir, "subfigure_records"), ["parent_image_id"], F.col("crop_status") == "ready")


@register(
    """SELECT parent_image_id, main_caption, expected_subcaption_count, caption_finish_reason, caption_generate_token_len, caption_max_new_tokens,
      caption_source_run_dir FROM align_parents WHERE caption_alignment_status = 'generation_truncated'"""
)
def retry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["parent_image_id", "main_caption", "expected_subcaption_count", "caption_finish_reason", "caption_generate_token_len", "caption_max_new_tokens", "caption_source_run_dir"]
    return recovery.retry_candidates(table(spark, sf_dir, "align_parents"), columns, "caption_alignment_status")


# -------------------------------------------------------------------------------------------- alignment end to end


def stand_in() -> Callable[[list[dict], int | None], dict[str, dict]]:
    """A caption model whose answers follow from the length of an id, so that SQL can tell them too."""

    def answer(rows: list[dict], limit: int | None) -> dict[str, dict]:
        out = {}
        for row in rows:
            name, n = row["request_id"], len(row["image_paths"]) - 1
            if name.endswith("3") and limit < 1000:
                raise MemoryError(name)
            cut = (len(name) + n) % 7 == 0 and limit < 1000
            parts = [f"part {i}" for i in range(n - (len(name) % 5 == 0))]
            out[name] = {"text": " || ".join(parts), "finish_reason": "length" if cut else "stop", "generate_token_len": len(parts)}
        return out

    return answer


@register(
    """WITH once AS (SELECT DISTINCT ON (parent_image_id, subfigure_index) parent_image_id, subfigure_index, main_caption FROM subfigure_records
      WHERE parent_image_id <> '' AND subfigure_index IS NOT NULL ORDER BY parent_image_id, subfigure_index, record_id),
    p AS (SELECT parent_image_id, count(*) AS n, arg_min(coalesce(main_caption, ''), subfigure_index) AS caption FROM once GROUP BY 1),
    q AS (SELECT *, CASE WHEN n - (length(parent_image_id) % 5 = 0)::INT = 0 THEN 'empty_prediction'
      WHEN length(parent_image_id) % 5 = 0 THEN 'count_mismatch' ELSE 'aligned' END AS whole FROM p),
    b AS (SELECT *, CASE WHEN trim(caption) = '' THEN 'missing_main_caption' WHEN parent_image_id LIKE '%3' THEN 'inference_failed'
      WHEN (length(parent_image_id) + n) % 7 = 0 THEN 'generation_truncated' ELSE whole END AS base FROM q),
    m AS (SELECT *, base IN ('inference_failed', 'generation_truncated') AS again FROM b)
    SELECT parent_image_id, CASE WHEN again AND whole = 'aligned' THEN 'aligned' ELSE base END AS status,
      CASE WHEN again AND whole = 'aligned' THEN 'retry' ELSE 'first_pass' END AS final_source, base AS base_status,
      CAST(again AS BIGINT) AS retry_attempts, CASE WHEN again THEN whole ELSE base END AS latest_status FROM m"""
)
def aligned_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions of all parents by a stand-in model, a second run over what failed or was cut off, and both merged."""
    rows = table(spark, sf_dir, "subfigure_records").where((F.col("parent_image_id") != "") & F.col("subfigure_index").isNotNull())
    values = F.struct(F.coalesce("main_caption", F.lit("")).alias("caption"), "local_panel_path", "parent_local_image_path")
    once = rows.groupBy("parent_image_id", "subfigure_index").agg(F.min_by(values, "record_id").alias("v")).select("parent_image_id", "subfigure_index", "v.*")
    base = pipelines.align(once, stand_in, "base", max_new_tokens=512)
    again = pipelines.retry(base, once, stand_in, "again", ["generation_truncated", "inference_failed"], max_new_tokens=2048)
    merged = pipelines.merge(("base", base), [("again", again)])["parents"]
    return merged.select("parent_image_id", "status", "final_source", "base_status", F.col("retry_attempts").cast("bigint").alias("retry_attempts"), "latest_status")


# ---------------------------------------------------------------------------------------- media of all deliveries

_ALL = f"""allrows AS (SELECT {_PMCID.format("pmcid")} AS article, figure_id AS figure, record_id, image_hrefs AS hrefs, image_s3_url AS url,
    {_VERSION.format("coalesce(nullif(trim(resolved_article_version), ''), article_version)")} AS version FROM singlepanel_records WHERE regexp_matches(pmcid, '[0-9]')),
  firsts AS (SELECT * FROM allrows QUALIFY row_number() OVER (PARTITION BY article, figure ORDER BY record_id) = 1)"""


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All records with an article, and of each figure the links of its first record."""
    rows = table(spark, sf_dir, "singlepanel_records").select(
        ids.canonical_pmcid(F.col("pmcid")).alias("article"), F.col("figure_id").alias("figure"), "record_id", F.col("image_hrefs").alias("hrefs"),
        F.col("image_s3_url").alias("url"), ids.current_version(F.col("resolved_article_version"), F.col("article_version")).alias("version"),
    ).where(F.col("article").isNotNull())
    return rows, rows.groupBy("article", "figure").agg(F.min_by("hrefs", "record_id").alias("hrefs"))


@register(
    f"""WITH {_ALL}, media AS (SELECT DISTINCT article, url, {_basename("url")} AS base, {_stem("url")} AS stem, {_rank("url")} AS rnk FROM allrows WHERE trim(url) <> ''),
    links AS (SELECT article, figure, pos, href, {_basename("href")} AS base, {_stem("href")} AS stem FROM
      (SELECT article, figure, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM firsts) WHERE trim(href) <> ''),
    met AS (SELECT l.*, m.url, m.rnk, 0 AS kind FROM links l JOIN media m ON m.article = l.article AND m.base = l.base
      UNION ALL SELECT l.*, m.url, m.rnk, 1 AS kind FROM links l JOIN media m ON m.article = l.article AND m.stem = l.stem)
    SELECT article, figure, href, url AS media_url, CASE kind WHEN 0 THEN 'basename' ELSE 'stem' END AS match_type FROM met
    QUALIFY row_number() OVER (PARTITION BY article, figure ORDER BY kind, pos, rnk, url, href) = 1"""
)
def media_matches_all_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, figures = _records(spark, sf_dir)
    links = figures.select("article", "figure", F.posexplode("hrefs").alias("at", "href"))
    return resolve.match_links(links, rows.select("article", "url"), ["article"], ["figure"])


@register(
    f"""WITH {_ALL}, media AS (SELECT DISTINCT article, version, {_basename("url")} AS base, {_stem("url")} AS stem FROM allrows WHERE version IS NOT NULL AND trim(url) <> ''),
    links AS (SELECT article, figure, {_basename("href")} AS base, {_stem("href")} AS stem FROM
      (SELECT article, figure, list_filter(hrefs, lambda x: trim(x) <> '')[1] AS href FROM firsts) WHERE href IS NOT NULL),
    hits AS (SELECT DISTINCT l.article, m.version, l.figure FROM links l JOIN media m ON m.article = l.article AND (m.base = l.base OR m.stem = l.stem)),
    cov AS (SELECT v.article, v.version, count(h.figure) AS coverage FROM (SELECT DISTINCT article, version FROM media) v
      LEFT JOIN hits h ON h.article = v.article AND h.version = v.version GROUP BY 1, 2)
    SELECT article, version, coverage FROM cov"""
)
def version_coverage_all_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, figures = _records(spark, sf_dir)
    primary = figures.select("article", "figure", resolve.first_href(F.col("hrefs")).alias("href"))
    media = rows.where(F.col("version").isNotNull() & (ids.strip(F.col("url")) != "")).select("article", "version", "url")
    return resolve.version_coverage(primary, media)


@register(
    f"""SELECT r.record_id FROM singlepanel_records r, store_targets t WHERE t.store_name = 'singlepanel' AND trim(r.local_image_path) <> '' AND NOT EXISTS
      (SELECT 1 FROM stored_files s JOIN store_targets t ON t.store_name = s.store_name
       WHERE s.store_name = 'singlepanel' AND {_place("s.stored_path")} = {_place("r.local_image_path").replace("t.root_dir", "(SELECT root_dir FROM store_targets WHERE store_name = 'singlepanel')")})"""
)
def missing_image_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose image is not listed under any spelling of its place."""
    stores = table(spark, sf_dir, "store_targets")
    place = ids.canonical_path(F.col("local_image_path"), F.lit(compaction.root_of(stores, "singlepanel")))
    rows = table(spark, sf_dir, "singlepanel_records").select("record_id", place.alias("path")).where(F.col("path").isNotNull())
    listed = compaction.distinct_files(table(spark, sf_dir, "stored_files"), stores).where(F.col("store_name") == "singlepanel")
    return alignment.without_files(rows, "path", listed, "place").select("record_id")
