"""Queries of the curation operators over the record tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figcurate import schemas
from figcurate.functions import ids, text
from figcurate.operators import alignment, candidates, compaction, panels, recovery, resolve, summary
from figcurate.plans.data_queries import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query

    return add


def _single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "singlepanel_records")


def _panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "subfigure_records")


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "align_parents")


# ------------------------------------------------------------------------------------------------ SQL fragments

_LIC = """CASE WHEN {0} IS NULL OR trim({0}) = '' THEN NULL
  WHEN contains(u, 'NO-CC CODE') OR u IN ('NO CC CODE', 'NONE', 'NULL', 'N/A') THEN 'NO-CC CODE'
  WHEN u = 'TDM' THEN u
  WHEN contains(u, 'BY-NC-ND') OR contains(u, 'BY NC ND') THEN 'CC BY-NC-ND'
  WHEN contains(u, 'BY-NC-SA') OR contains(u, 'BY NC SA') THEN 'CC BY-NC-SA'
  WHEN contains(u, 'BY-ND') OR contains(u, 'BY ND') THEN 'CC BY-ND'
  WHEN contains(u, 'BY-SA') OR contains(u, 'BY SA') THEN 'CC BY-SA'
  WHEN contains(u, 'BY-NC') OR contains(u, 'BY NC') THEN 'CC BY-NC'
  WHEN contains(u, 'CC0') OR contains(u, 'PUBLIC DOMAIN DEDICATION') THEN 'CC0'
  WHEN contains(u, 'CC BY') OR contains(u, '/BY/') THEN 'CC BY' ELSE u END"""
_UPPER = "replace(regexp_replace(upper(trim({0})), '\\s+', ' ', 'g'), '_', '-')"
_UNQUOTE = "url_decode(replace({0}, '+', '%2B'))"
_LAST = "regexp_extract({0}, '([^/]+)/*$', 1)"
_EXT = "(?i)\\.(jpeg|jpg|png|tiff|tif|gif|webp|bmp)$"
_PATH = "CASE WHEN regexp_matches({0}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)', 1) ELSE {0} END"


def _basename(x: str) -> str:
    return f"lower({_LAST.format(_UNQUOTE.format(_PATH.format(x)))})"


def _stem(x: str) -> str:
    return f"regexp_replace({_basename(x)}, '{_EXT}', '')"


def _rank(x: str) -> str:
    ext = f"regexp_extract({_basename(x)}, '[^.](\\.[^.]+)$', 1)"
    cases = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(text.RASTER_SUFFIXES))
    return f"CASE {ext} {cases} ELSE {len(text.RASTER_SUFFIXES) + 1} END"


def _graphic(x: str, ext: str = _EXT) -> str:
    bare = f"regexp_replace({_UNQUOTE.format(f'coalesce({x}, {chr(39) * 2})')}, '[?#].*$', '')"
    return f"regexp_replace({_LAST.format(bare)}, '{ext}', '')"


def _given(*columns: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({c}, '')" for c in columns) + ", '')"


# ------------------------------------------------------------------------------------- text and id expressions


@register(
    f"""WITH r AS (SELECT license, {_UPPER.format("license")} AS u FROM singlepanel_records),
    c AS (SELECT {_LIC.format("license")} AS license FROM r)
    SELECT license, coalesce(license IN ('CC BY', 'CC BY-NC', 'CC BY-NC-SA', 'CC0', 'CC BY-SA'), false) AS allowed, count(*) AS n
    FROM c GROUP BY 1, 2"""
)
def license_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _single(spark, sf_dir).select(
        text.canonical_license(F.col("license")).alias("license"), text.license_allowed(F.col("license")).alias("allowed")
    )
    return rows.groupBy("license", "allowed").agg(F.count("*").alias("n"))


@register(
    r"""WITH d AS (SELECT DISTINCT pmcid, article_version FROM singlepanel_records),
    e AS (SELECT *, regexp_extract(upper(trim(pmcid)), 'PMC\d+') AS prefix, coalesce(upper(trim(article_version)), '') AS raw FROM d),
    f AS (SELECT *, coalesce(nullif(regexp_extract(raw, '^([0-9]+)$', 1), ''), nullif(regexp_extract(raw, '\.([0-9]+)$', 1), '')) AS num FROM e),
    g AS (SELECT pmcid, article_version,
      CASE WHEN regexp_extract(pmcid, '(?i)\bPMC\d+\b') <> '' THEN upper(regexp_extract(pmcid, '(?i)\bPMC\d+\b'))
           WHEN regexp_replace(pmcid, '\D', '', 'g') <> '' THEN 'PMC' || regexp_replace(pmcid, '\D', '', 'g') END AS anywhere,
      coalesce(prefix, '') AS prefix,
      CASE WHEN prefix <> '' AND num IS NOT NULL THEN prefix || '.' || CAST(CAST(num AS BIGINT) AS VARCHAR) ELSE '' END AS versioned
      FROM f)
    SELECT *, coalesce(TRY_CAST(nullif(regexp_extract(versioned, '^PMC[0-9]+\.([0-9]+)$', 1), '') AS BIGINT), -1) AS version_no FROM g"""
)
def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _single(spark, sf_dir).select("pmcid", "article_version").distinct()
    versioned = rows.withColumns(
        {
            "anywhere": text.pmcid_anywhere(F.col("pmcid")),
            "prefix": text.pmcid_prefix(F.col("pmcid")),
            "versioned": text.versioned_pmcid(F.col("pmcid"), F.col("article_version")),
        }
    )
    return versioned.withColumn("version_no", text.version_number(F.col("versioned")))


@register(
    f"""SELECT record_id, {_basename("image_s3_url")} AS url_basename, {_stem("image_s3_url")} AS url_stem,
    CAST({_rank("image_s3_url")} AS INTEGER) AS url_rank, {_basename("selected_image_href")} AS href_basename,
    {_stem("selected_image_href")} AS href_stem,
    coalesce(regexp_matches(local_image_path, '{_EXT}'), false) AS is_raster FROM singlepanel_records"""
)
def media_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, href = F.col("image_s3_url"), F.col("selected_image_href")
    return _single(spark, sf_dir).select(
        "record_id",
        text.media_basename(url).alias("url_basename"),
        text.media_stem(url).alias("url_stem"),
        text.media_rank(url).cast("int").alias("url_rank"),
        text.media_basename(href).alias("href_basename"),
        text.media_stem(href).alias("href_stem"),
        text.is_raster(F.col("local_image_path")).alias("is_raster"),
    )


@register(
    f"""SELECT record_id, regexp_extract(image_s3_url, '^s3://([^/?#]+)', 1) AS bucket,
    {_UNQUOTE.format("regexp_extract(image_s3_url, '^s3://[^/?#]+/+([^?#]*)', 1)")} AS object_key,
    lower(regexp_extract(image_s3_url, '[?&]md5=([^&#]*)', 1)) AS md5
    FROM singlepanel_records WHERE regexp_matches(image_s3_url, '^s3://[^/?#]+/')"""
)
def object_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _single(spark, sf_dir).select("record_id", text.object_url(F.col("image_s3_url")).alias("o"))
    return rows.where(F.col("o").isNotNull()).select("record_id", "o.bucket", F.col("o.key").alias("object_key"), "o.md5")


_NOBMP = "(?i)\\.(jpeg|jpg|png|tiff|tif|gif|webp)$"


@register(
    f"""WITH r AS (SELECT record_id, coalesce(pmcid, '') AS p, coalesce(figure_id, '') AS f,
      {_graphic(_given("selected_image_href", "local_image_path", "figure_id"), _NOBMP)} AS g,
      {_graphic(_given("selected_image_href", "local_image_path", "figure_id"))} AS h FROM singlepanel_records)
    SELECT record_id,
      p || '_' || CASE WHEN p <> '' AND g <> '' THEN g ELSE coalesce(nullif(f, ''), 'figure') END AS parent_id,
      CASE WHEN p <> '' THEN p || '_' ELSE '' END || coalesce(nullif(h, ''), nullif(f, ''), 'figure') AS single_id,
      p || '_' || CASE WHEN p <> '' AND g <> '' THEN g ELSE coalesce(nullif(f, ''), 'figure') END || '_7' AS panel_id
    FROM r"""
)
def image_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.col(c) for c in ("pmcid", "selected_image_href", "local_image_path", "figure_id")]
    parent = text.parent_image_id(*parts)
    return _single(spark, sf_dir).select(
        "record_id", parent.alias("parent_id"), text.single_image_id(*parts).alias("single_id"),
        text.subfigure_id(parent, F.lit(7)).alias("panel_id"),
    )


@register(
    """SELECT record_id,
      '"Caption": ' || coalesce(caption, '') || chr(10) || '"Reference Text": ' ||
        coalesce(array_to_string(coalesce(reference_texts_screening, reference_texts, []), chr(10)), '') AS recursive_input,
      '"Caption": ' || coalesce(caption, '') || chr(10) || '"Reference Text": ' ||
        coalesce(array_to_string(coalesce(reference_texts, []), chr(10)), '') AS clean_input
    FROM singlepanel_records"""
)
def screening_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    override, plain = F.col("reference_texts_screening"), F.col("reference_texts")
    return _single(spark, sf_dir).select(
        "record_id",
        text.screening_input(F.col("caption"), text.screening_references(override, plain)).alias("recursive_input"),
        text.screening_input(F.col("caption"), text.screening_references(override, plain, recursive=False)).alias("clean_input"),
    )


_PROMPT_SQL = """SELECT record_id, CASE WHEN expected_subcaption_count >= 1 THEN '{0}' || expected_subcaption_count || '{1}' || chr(10) || chr(10)
  || '# Compound Figure' || chr(10) || '<IMAGE_TOKEN>' || chr(10)
  || repeat('# Subfigure' || chr(10) || '<IMAGE_TOKEN>' || chr(10), expected_subcaption_count)
  || '# Main Caption' || chr(10) || coalesce(main_caption, '') END AS prompt FROM align_parents""".format(*text.INSTRUCTION)


@register(_PROMPT_SQL)
def caption_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parents(spark, sf_dir).select(
        "record_id", text.caption_prompt(F.col("main_caption"), F.col("expected_subcaption_count")).alias("prompt")
    )


@register(
    r"""SELECT record_id, regexp_replace(trim(regexp_replace(coalesce(text, ''), '[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), '^ +| +$', '', 'g') AS clean
    FROM (SELECT record_id, caption AS text FROM singlepanel_records)"""
)
def clean_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _single(spark, sf_dir).select("record_id", text.clean_text(F.col("caption")).alias("clean"))


# ------------------------------------------------------------------------------------------- resolution of media

def _figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per figure: its first record with an article; article, figure, version, links and address."""
    rows = _single(spark, sf_dir).select(
        ids.canonical_pmcid(F.col("pmcid")).alias("article"), F.col("figure_id").alias("figure"), "record_id",
        ids.current_version(F.col("resolved_article_version"), F.col("article_version")).alias("version"),
        F.col("image_hrefs").alias("hrefs"), F.col("image_s3_url").alias("url"),
    )
    return summary.first_per_key(rows.where(F.col("article").isNotNull()), ["article", "figure"], ["record_id"])


_FIGS = r"""figs AS (SELECT * FROM (
  SELECT CASE WHEN regexp_extract(pmcid, '[0-9]+') <> '' THEN 'PMC' || regexp_extract(pmcid, '[0-9]+') END AS article,
    figure_id AS figure, record_id, image_hrefs AS hrefs, image_s3_url AS url,
    TRY_CAST(regexp_extract(coalesce(nullif(trim(resolved_article_version), ''), article_version), '(?:^|\.)\s*([0-9]+)\s*$', 1) AS BIGINT) AS version
  FROM singlepanel_records) WHERE article IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY article, figure ORDER BY record_id) = 1)"""
_MEDIA = f"""media AS (SELECT DISTINCT article, url, {_basename("url")} AS base, {_stem("url")} AS stem, {_rank("url")} AS rnk
  FROM figs WHERE trim(url) <> '')"""
_LINKS = f"""links AS (SELECT article, figure, pos, href, {_basename("href")} AS base, {_stem("href")} AS stem FROM
  (SELECT article, figure, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM figs) WHERE trim(href) <> '')"""
_MET = """met AS (
  SELECT l.article, l.figure, l.pos, l.href, m.url, m.rnk, 0 AS kind FROM links l JOIN media m ON m.article = l.article AND m.base = l.base
  UNION ALL
  SELECT l.article, l.figure, l.pos, l.href, m.url, m.rnk, 1 AS kind FROM links l JOIN media m ON m.article = l.article AND m.stem = l.stem)"""


def _links_and_media(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    figures = _figures(spark, sf_dir)
    links = figures.select("article", "figure", F.posexplode("hrefs").alias("at", "href"))
    return links, figures.select("article", "url").distinct()


@register(
    f"""WITH {_FIGS}, {_MEDIA}, {_LINKS}, {_MET}
    SELECT article, figure, href, url AS media_url, CASE kind WHEN 0 THEN 'basename' ELSE 'stem' END AS match_type FROM met
    QUALIFY row_number() OVER (PARTITION BY article, figure ORDER BY kind, pos, rnk, url, href) = 1"""
)
def media_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, media = _links_and_media(spark, sf_dir)
    return resolve.match_links(links, media, ["article"], ["figure"])


@register(
    f"""WITH {_FIGS}, {_MEDIA}, {_LINKS}, {_MET},
    best AS (SELECT article, figure, pos, url FROM met
      QUALIFY row_number() OVER (PARTITION BY article, figure, pos ORDER BY kind, rnk, url, href) = 1)
    SELECT article, figure, count(DISTINCT url) AS candidates FROM best GROUP BY 1, 2"""
)
def media_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, media = _links_and_media(spark, sf_dir)
    return resolve.candidate_counts(links, media, ["article"], ["figure"])


@register(
    f"""WITH {_FIGS}, named AS (SELECT DISTINCT article, version, url FROM figs WHERE version IS NOT NULL AND trim(url) <> ''),
    media AS (SELECT article, version, {_basename("url")} AS base, {_stem("url")} AS stem FROM named),
    prim AS (SELECT article, figure, nullif(list_filter(hrefs, lambda x: trim(x) <> '')[1], '') AS href FROM figs),
    links AS (SELECT article, figure, {_basename("href")} AS base, {_stem("href")} AS stem FROM prim WHERE href IS NOT NULL),
    hits AS (SELECT DISTINCT l.article, m.version, l.figure FROM links l JOIN media m
      ON m.article = l.article AND (m.base = l.base OR m.stem = l.stem)),
    cov AS (SELECT v.article, v.version, count(h.figure) AS coverage FROM (SELECT DISTINCT article, version FROM named) v
      LEFT JOIN hits h ON h.article = v.article AND h.version = v.version GROUP BY 1, 2),
    want AS (SELECT article, count(*) AS n FROM prim GROUP BY 1),
    decl AS (SELECT article, min(version) AS declared FROM figs GROUP BY 1),
    rated AS (SELECT c.*, coalesce(d.declared = c.version AND w.n = c.coverage, false) AS exact,
      count(*) OVER (PARTITION BY c.article) AS candidates
      FROM cov c JOIN want w ON w.article = c.article LEFT JOIN decl d ON d.article = c.article),
    best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY article ORDER BY exact DESC, coverage DESC, version DESC) = 1)
    SELECT w.article, b.version, CASE WHEN b.article IS NULL THEN 'metadata_not_found' WHEN b.exact THEN 'explicit_version'
      WHEN b.coverage > 0 THEN 'media_match' ELSE 'latest_version_no_media_match' END AS method,
      coalesce(b.candidates, 0) AS candidates, coalesce(b.coverage, 0) AS coverage
    FROM want w LEFT JOIN best b ON b.article = w.article"""
)
def version_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = _figures(spark, sf_dir)
    primary = figures.select("article", "figure", resolve.first_href(F.col("hrefs")).alias("href"))
    media = figures.where(F.col("version").isNotNull() & (ids.strip(F.col("url")) != "")).select("article", "version", "url").distinct()
    declared = figures.groupBy("article").agg(F.min("version").alias("declared"))
    return resolve.resolve_versions(primary, media, declared)


# ------------------------------------------------------------------------------------------ article and screening


@register(
    r"""WITH r AS (SELECT CASE WHEN regexp_extract(pmcid, '[0-9]+') <> '' THEN 'PMC' || regexp_extract(pmcid, '[0-9]+') END AS pmcid,
      journal_title, license, landed_at, record_id FROM singlepanel_records)
    SELECT pmcid, journal_title, license, record_id FROM r WHERE pmcid IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY pmcid ORDER BY landed_at DESC, record_id DESC) = 1"""
)
def articles_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _single(spark, sf_dir).select(
        ids.canonical_pmcid(F.col("pmcid")).alias("pmcid"), "journal_title", "license", "landed_at", "record_id"
    )
    return summary.last_per_key(rows.where(F.col("pmcid").isNotNull()), ["pmcid"], ["landed_at", "record_id"]).drop("landed_at")


@register(
    f"""WITH r AS (SELECT *, {_UPPER.format("license")} AS u FROM singlepanel_records),
    c AS (SELECT article_is_retracted AS gone, {_LIC.format("license")} AS lic FROM r)
    SELECT count(*) AS "rows", count(*) FILTER (coalesce(gone, false)) AS retracted,
      count(*) FILTER (NOT coalesce(gone, false) AND NOT coalesce(lic IN ('CC BY', 'CC BY-NC', 'CC BY-NC-SA', 'CC0', 'CC BY-SA'), false)) AS other_license,
      count(*) FILTER (NOT coalesce(gone, false) AND lic IN ('CC BY', 'CC BY-NC', 'CC BY-NC-SA', 'CC0', 'CC BY-SA')) AS parsed FROM c"""
)
def article_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.coalesce("article_is_retracted", F.lit(False))
    allowed = text.license_allowed(F.col("license"))
    return summary.counters(_single(spark, sf_dir), retracted=gone, other_license=~gone & ~allowed, parsed=~gone & allowed)


@register(
    """SELECT vec_id, round(1 / (1 + exp(CAST(embedding[1] AS DOUBLE) - CAST(embedding[2] AS DOUBLE))), 6) AS score,
      1 / (1 + exp(CAST(embedding[1] AS DOUBLE) - CAST(embedding[2] AS DOUBLE))) >= 0.5 AS retained FROM embeddings"""
)
def screening_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = text.positive_share(F.slice("embedding", 1, 2))
    scored = table(spark, sf_dir, "embeddings").select("vec_id", share.alias("score"))
    return scored.select("vec_id", F.round("score", 6).alias("score"), text.reaches(F.col("score"), 0.5).alias("retained"))


@register(
    """SELECT count(*) AS "rows", count(*) FILTER (CAST(screening_score AS DOUBLE) >= 0.6) AS kept,
      count(*) FILTER (CAST(screening_score AS DOUBLE) < 0.6) AS dropped FROM singlepanel_records"""
)
def screening_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.screened(_single(spark, sf_dir), "screening_score", 0.6)
    return summary.counters(rows, kept=F.col("retained"), dropped=~F.col("retained"))


@register("SELECT record_id FROM singlepanel_records WHERE retained")
def retained_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.retained_only(_single(spark, sf_dir)).select("record_id")


@register(
    """SELECT record_id, CAST(CASE WHEN s > 0.3 THEN 1 WHEN s IS NOT NULL THEN 0 END AS TINYINT) AS multipanel_label, s > 0.3 AS is_multipanel,
      CASE WHEN NOT ok THEN 'skipped_image_not_ready' WHEN s IS NULL THEN 'decode_failed' ELSE 'classified' END AS detection_status
    FROM (SELECT record_id, coalesce(image_status = 'ready', false) AS ok,
      CASE WHEN image_status = 'ready' THEN CAST(multipanel_score AS DOUBLE) END AS s FROM singlepanel_records)"""
)
def detection_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.detected(_single(spark, sf_dir), "multipanel_score", F.col("image_status") == "ready", threshold=0.3)
    return rows.select("record_id", "multipanel_label", "is_multipanel", "detection_status")


@register(
    """SELECT 'all' AS route, count(*) AS n FROM singlepanel_records UNION ALL
    SELECT 'positive', count(*) FROM singlepanel_records WHERE image_status = 'ready' AND CAST(multipanel_score AS DOUBLE) > 0.3 UNION ALL
    SELECT 'negative', count(*) FROM singlepanel_records WHERE image_status = 'ready' AND CAST(multipanel_score AS DOUBLE) <= 0.3"""
)
def detection_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.detected(_single(spark, sf_dir), "multipanel_score", F.col("image_status") == "ready", threshold=0.3)
    counted = [df.agg(F.lit(name).alias("route"), F.count("*").alias("n")) for name, df in candidates.routes(rows, "is_multipanel").items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# ------------------------------------------------------------------------------------------------------- panels

_BOXES = """boxes AS (SELECT coalesce(parent_image_id, '') AS parent, record_id, box_x1 / greatest(coalesce(CAST(parent_image_width AS DOUBLE), 1), 1) AS x,
  box_y1 / greatest(coalesce(CAST(parent_image_height AS DOUBLE), 1), 1) AS y FROM subfigure_records)"""


@register(
    f"""WITH {_BOXES}, gaps AS (SELECT *, CASE WHEN abs(y - lag(y) OVER (PARTITION BY parent ORDER BY y, record_id)) > 0.05 THEN 1 ELSE 0 END AS brk FROM boxes),
    lines AS (SELECT *, sum(brk) OVER (PARTITION BY parent ORDER BY y, record_id ROWS UNBOUNDED PRECEDING) AS line FROM gaps)
    SELECT parent, record_id, row_number() OVER (PARTITION BY parent ORDER BY line, x, y, record_id) - 1 AS panel_order FROM lines"""
)
def panel_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _panels(spark, sf_dir).select(text.text_or_empty(F.col("parent_image_id")).alias("parent"), "record_id", "box_x1", "box_y1",
                                        "parent_image_width", "parent_image_height")
    ordered = panels.reading_order(rows, ["parent"], "record_id", "box_x1", "box_y1", "parent_image_width", "parent_image_height")
    return ordered.select("parent", "record_id", "panel_order")


@register(
    """SELECT record_id, round(box_x1 / greatest(coalesce(parent_image_width, 1), 1), 9) AS x1, round(box_y2 / greatest(coalesce(parent_image_height, 1), 1), 9) AS y2
    FROM subfigure_records"""
)
def panel_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _panels(spark, sf_dir).select(
        "record_id",
        F.round(panels.normalised_box(F.col("box_x1"), F.col("parent_image_width")), 9).alias("x1"),
        F.round(panels.normalised_box(F.col("box_y2"), F.col("parent_image_height")), 9).alias("y2"),
    )


_PARENT_KEY = "nullif(regexp_replace(trim(parent_image_id), '(?i)\\.(jpg|png)$', ''), '')"


def _keyed_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _panels(spark, sf_dir).withColumn("parent", ids.canonical_image_id(F.col("parent_image_id")))
    return rows.where(F.col("parent").isNotNull())


@register(
    f"""SELECT parent, count(*) AS panel_count, count(*) FILTER (crop_status = 'ready') AS ready_count,
      CASE WHEN count(*) = count(*) FILTER (crop_status = 'ready') THEN 'separated' ELSE 'partial_crop_failure' END AS separation_status
    FROM (SELECT {_PARENT_KEY} AS parent, crop_status FROM subfigure_records) WHERE parent IS NOT NULL GROUP BY 1"""
)
def panel_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.panel_counts(_keyed_panels(spark, sf_dir), ["parent"], F.col("crop_status") == "ready")


@register(
    f"""SELECT parent, array_to_string(list(record_id ORDER BY subfigure_index, record_id), ' ') AS records FROM
    (SELECT {_PARENT_KEY} AS parent, * FROM subfigure_records) WHERE parent IS NOT NULL GROUP BY 1"""
)
def panel_nesting(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = panels.nested(_keyed_panels(spark, sf_dir), ["parent"], ["subfigure_index", "record_id"], [])
    return nested.select("parent", F.array_join(F.transform("panels", lambda p: p["record_id"].cast("string")), " ").alias("records"))


@register(
    f"""SELECT parent, count(*) AS panel_count, min(subfigure_index) = 0 AND max(subfigure_index) = count(*) - 1
      AND count(DISTINCT subfigure_index) = count(*) AS contiguous
    FROM (SELECT {_PARENT_KEY} AS parent, subfigure_index FROM subfigure_records) WHERE parent IS NOT NULL GROUP BY 1"""
)
def panel_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.contiguity(_keyed_panels(spark, sf_dir), ["parent"], "subfigure_index")


@register("SELECT record_id, CAST((row_number() OVER (ORDER BY record_id) - 1) // 100 AS BIGINT) AS shard FROM align_parents")
def parent_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.numbered_chunks(_parents(spark, sf_dir).select("record_id"), "record_id", 100)


@register(
    """WITH RECURSIVE r AS (SELECT record_id // 50 AS shard, record_id, coalesce(expected_subcaption_count, 0) + 1 AS n,
      row_number() OVER (PARTITION BY record_id // 50 ORDER BY coalesce(expected_subcaption_count, 0) + 1, record_id) AS k FROM align_parents),
    b AS (SELECT shard, record_id, n, k, 0 AS batch, 1 AS held, n AS images FROM r WHERE k = 1
      UNION ALL
      SELECT r.shard, r.record_id, r.n, r.k, b.batch + CASE WHEN b.held >= 4 OR b.images + r.n > 20 THEN 1 ELSE 0 END,
        CASE WHEN b.held >= 4 OR b.images + r.n > 20 THEN 1 ELSE b.held + 1 END,
        CASE WHEN b.held >= 4 OR b.images + r.n > 20 THEN r.n ELSE b.images + r.n END
      FROM b JOIN r ON r.shard = b.shard AND r.k = b.k + 1)
    SELECT shard, record_id, CAST(batch AS BIGINT) AS batch FROM b"""
)
def request_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parents(spark, sf_dir).select(
        F.expr("record_id div 50").alias("shard"), "record_id", (F.coalesce("expected_subcaption_count", F.lit(0)) + 1).alias("images")
    )
    return panels.packed_batches(rows, ["shard"], "images", "record_id", 4, 20).select("shard", "record_id", "batch")


# ---------------------------------------------------------------------------------------------------- alignment

_PARTS = """parts AS (SELECT record_id, parent_image_id, raw_prediction, expected_subcaption_count AS expected, caption_finish_reason AS fin,
  CASE WHEN body = '' THEN [] ELSE list_transform(string_split(body, '||'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) END AS p FROM
  (SELECT *, CASE WHEN regexp_matches(t, '(?s)^```[^\\n]*\\n(.*\\n)?[^\\n]*```$')
      THEN regexp_replace(regexp_extract(t, '(?s)^```[^\\n]*\\n(.*\\n)?[^\\n]*```$', 1), '^\\s+|\\s+$', '', 'g') ELSE t END AS body FROM
    (SELECT *, coalesce(regexp_replace(raw_prediction, '^\\s+|\\s+$', '', 'g'), '') AS t FROM align_parents)))"""
_STATUS = """CASE WHEN lower(coalesce(fin, '')) = 'length' THEN 'generation_truncated' WHEN len(p) = 0 THEN 'empty_prediction'
  WHEN len(p) <> expected THEN 'count_mismatch' WHEN list_contains(p, '') THEN 'empty_subcaption' ELSE 'aligned' END"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.judged(_parents(spark, sf_dir), "raw_prediction", "expected_subcaption_count", "caption_finish_reason")


@register(f"WITH {_PARTS} SELECT record_id, array_to_string(p, ' / ') AS parts, len(p) AS predicted_count, {_STATUS} AS status FROM parts")
def prediction_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select("record_id", F.array_join("parts", " / ").alias("parts"), "predicted_count", "status")


@register(f"WITH {_PARTS}, s AS (SELECT {_STATUS} AS value FROM parts) SELECT value, count(*) AS n FROM s GROUP BY 1")
def alignment_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.histogram(_judged(spark, sf_dir), F.col("status"))


@register(
    f"""WITH {_PARTS}, good AS (SELECT record_id AS attempt, trim(parent_image_id) AS parent, p FROM parts WHERE {_STATUS} = 'aligned'),
    flat AS (SELECT attempt, parent, unnest(p) AS subcaption, generate_subscripts(p, 1) - 1 AS idx FROM good)
    SELECT s.record_id, f.attempt, f.subcaption FROM subfigure_records s JOIN flat f ON f.parent = trim(s.parent_image_id) AND f.idx = s.subfigure_index"""
)
def panel_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ids.strip(F.col("parent_image_id")).alias("parent")
    parents = _judged(spark, sf_dir).select(F.col("record_id").alias("attempt"), key, "parts", "status")
    rows = _panels(spark, sf_dir).select("record_id", key, "subfigure_index")
    joined = alignment.panel_captions(parents.withColumn("parts", F.transform("parts", lambda p: F.struct(p.alias("text"), F.col("attempt").alias("attempt")))), rows, ["parent"], "subfigure_index")
    return joined.select("record_id", "subcaption.attempt", F.col("subcaption.text").alias("subcaption"))


@register(
    """WITH p AS (SELECT DISTINCT parent_image_id FROM align_parents), c AS (SELECT parent_image_id, count(*) AS n FROM subfigure_records
      WHERE crop_status = 'ready' GROUP BY 1)
    SELECT p.parent_image_id, c.n AS n_panels FROM p JOIN c ON c.parent_image_id = p.parent_image_id WHERE c.n BETWEEN 2 AND 6"""
)
def parents_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = alignment.matching(_panels(spark, sf_dir), crop_status="ready")
    return alignment.parents_with_panels(_parents(spark, sf_dir).select("parent_image_id").distinct(), ready, ["parent_image_id"], 2, 6)


@register(
    """SELECT count(*) AS batches, CAST(sum(n) AS BIGINT) AS parents, CAST(sum(i) AS BIGINT) AS images, round(sum(s), 6) AS seconds,
      round(sum(n) / sum(s), 6) AS parents_per_second, round(sum(i) / sum(s), 6) AS images_per_second
    FROM (SELECT max(inference_batch_seconds) AS s, max(inference_batch_image_count) AS i, count(*) AS n FROM align_parents
      GROUP BY caption_source_run_dir, inference_batch_size, inference_batch_image_count, inference_batch_seconds)"""
)
def alignment_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["caption_source_run_dir", "inference_batch_size", "inference_batch_image_count", "inference_batch_seconds"]
    return alignment.run_summary(_parents(spark, sf_dir), key, F.col("inference_batch_seconds"), F.col("inference_batch_image_count"))


@register(
    """SELECT record_id FROM singlepanel_records r WHERE local_image_path IS NULL OR NOT EXISTS
      (SELECT 1 FROM stored_files f WHERE f.stored_path = '/data/figstore/singlepanel/' || r.local_image_path)"""
)
def missing_image_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compares places, however a path is written; the SQL, which is kept, compares spellings and so reports more."""
    stores = table(spark, sf_dir, "store_targets")
    place = ids.canonical_path(F.col("local_image_path"), F.lit(compaction.root_of(stores, "singlepanel")))
    rows = _single(spark, sf_dir).select("record_id", place.alias("path"))
    return alignment.without_files(rows, "path", compaction.distinct_files(table(spark, sf_dir, "stored_files"), stores), "place").select("record_id")


# ----------------------------------------------------------------------------------------------------- recovery


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts in order: base runs first, then the retries by the number at the end of their name, then by record."""
    rows = _parents(spark, sf_dir).where(ids.strip(F.col("parent_image_id")) != "")
    retry = F.col("caption_run_kind") == "retry"
    number = F.regexp_extract("caption_source_run_dir", "([0-9]+)$", 1).try_cast("int")
    return rows.select(
        "parent_image_id", "record_id", F.col("caption_alignment_status").alias("status"),
        F.when(retry, F.coalesce(number, F.lit(1))).otherwise(0).alias("run_order"),
        F.col("caption_source_run_dir").alias("run_name"),
        F.when(retry, F.lit("retry")).otherwise(F.lit("first_pass")).alias("run_kind"),
        F.col("record_id").alias("attempt_at"),
    )


_RUNS = r"""runs AS (SELECT parent_image_id, record_id, caption_alignment_status AS status, caption_source_run_dir AS run_name,
  CASE WHEN caption_run_kind = 'retry' THEN coalesce(TRY_CAST(regexp_extract(caption_source_run_dir, '([0-9]+)$', 1) AS INTEGER), 1) ELSE 0 END AS run_order,
  CASE WHEN caption_run_kind = 'retry' THEN 'retry' ELSE 'first_pass' END AS run_kind
  FROM align_parents WHERE trim(parent_image_id) <> '')"""
_MERGED = f"""{_RUNS},
sel AS (SELECT * FROM runs WHERE run_order = 0 OR status = 'aligned' QUALIFY row_number() OVER (PARTITION BY parent_image_id ORDER BY run_order DESC, record_id DESC) = 1),
base AS (SELECT parent_image_id, status AS base_status FROM runs WHERE run_order = 0 QUALIFY row_number() OVER (PARTITION BY parent_image_id ORDER BY record_id DESC) = 1),
late AS (SELECT parent_image_id, status AS latest_status, run_name AS latest_run FROM runs QUALIFY row_number() OVER (PARTITION BY parent_image_id ORDER BY run_order DESC, record_id DESC) = 1),
tries AS (SELECT parent_image_id, count(*) FILTER (run_order > 0) AS retry_attempts FROM runs GROUP BY 1),
merged AS (SELECT s.parent_image_id, s.record_id, s.status, s.run_kind AS final_source, s.run_name AS final_run, b.base_status, t.retry_attempts, l.latest_status, l.latest_run
  FROM sel s JOIN base b USING (parent_image_id) JOIN tries t USING (parent_image_id) JOIN late l USING (parent_image_id))"""


@register(f"WITH {_MERGED} SELECT * FROM merged")
def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = recovery.merged(_runs(spark, sf_dir), "parent_image_id", "status")
    return merged.select("parent_image_id", "record_id", "status", "final_source", "final_run", "base_status", "retry_attempts", "latest_status", "latest_run")


@register(
    f"""WITH {_RUNS}, steps AS (SELECT *, lag(status) OVER (PARTITION BY parent_image_id ORDER BY run_order, record_id) AS previous FROM runs)
    SELECT coalesce(previous, '') AS previous, status, count(*) AS n FROM steps WHERE run_order > 0 GROUP BY 1, 2"""
)
def retry_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.transitions(_runs(spark, sf_dir), "parent_image_id", "status")


@register(f"WITH {_RUNS} SELECT run_name, count(*) FILTER (status = 'aligned') AS replacements FROM runs WHERE run_order > 0 GROUP BY 1")
def retry_replacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.replacements(_runs(spark, sf_dir), "status")


@register(f"WITH {_MERGED} SELECT count(*) FILTER (base_status <> 'aligned' AND status = 'aligned') AS recovered FROM merged")
def retry_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.recovered(recovery.merged(_runs(spark, sf_dir), "parent_image_id", "status"), "status")


@register(f"WITH {_RUNS} SELECT DISTINCT parent_image_id FROM runs WHERE status IN ('generation_truncated', 'count_mismatch')")
def retry_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.with_status(_runs(spark, sf_dir), "parent_image_id", "status", ["generation_truncated", "count_mismatch"])


@register(
    f"""WITH {_MERGED} SELECT s.record_id FROM subfigure_records s JOIN merged m
      ON m.parent_image_id = s.parent_image_id AND m.final_run = s.caption_source_run_dir"""
)
def panels_of_chosen_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = recovery.merged(_runs(spark, sf_dir), "parent_image_id", "status")
    rows = _panels(spark, sf_dir).select("record_id", "parent_image_id", F.col("caption_source_run_dir").alias("run_name"))
    return recovery.rows_of_chosen_run(rows, merged, "parent_image_id").select("record_id")


# -------------------------------------------------------------------------------------------------------- union


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    figures = alignment.matching(_single(spark, sf_dir), image_status="ready", is_multipanel=False)
    chosen = alignment.matching(_panels(spark, sf_dir), crop_status="ready", caption_alignment_status="aligned")
    return candidates.candidates(figures, chosen.where(ids.strip(F.col("subcaption")) != ""))


_SHARED = ", ".join(f"coalesce({c}, '') AS {c}" for c in ("pmcid", "article_version", "resolved_article_version", "pmid"))
_UNION = f"""cand AS (
  SELECT 'single_panel' AS source_type, {_SHARED}, coalesce(journal_title, '') AS journal_title,
    CASE WHEN coalesce(pmcid, '') <> '' THEN pmcid || '_' ELSE '' END ||
      coalesce(nullif({_graphic(_given("selected_image_href", "local_image_path", "figure_id"))}, ''), nullif(figure_id, ''), 'figure') AS image_id,
    NULL::BIGINT AS subfigure_index, coalesce(local_image_path, '') AS local_image_path, coalesce(caption, '') AS caption,
    array_to_string(coalesce(reference_texts, []), ' / ') AS reference_texts, CAST(multipanel_score AS DOUBLE) AS upstream_score
  FROM singlepanel_records WHERE image_status = 'ready' AND is_multipanel = false
  UNION ALL
  SELECT 'subfigure', {_SHARED}, '', {_given("image_id", "panel_image_id")}, subfigure_index, coalesce(local_panel_path, ''),
    coalesce(subcaption, ''), array_to_string(coalesce(reference_texts, []), ' / '), panel_confidence
  FROM subfigure_records WHERE crop_status = 'ready' AND caption_alignment_status = 'aligned' AND trim(subcaption) <> '')"""


@register(f"WITH {_UNION} SELECT * FROM cand")
def candidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir).select(
        "source_type", "pmcid", "article_version", "resolved_article_version", "pmid", "journal_title", "image_id", "subfigure_index",
        "local_image_path", "caption", F.array_join("reference_texts", " / ").alias("reference_texts"), "upstream_score",
    )


@register(
    f"""WITH {_UNION} SELECT source_type, upstream_score > 0.5 AS is_medical, CASE WHEN upstream_score > 0.5 THEN 'medical' WHEN upstream_score IS NOT NULL THEN 'other' END AS medical_class_name,
      count(*) AS n FROM cand GROUP BY 1, 2, 3"""
)
def candidate_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates.classified(_candidates(spark, sf_dir), "upstream_score", 0.5, 1, ("other", "medical"))
    return rows.groupBy("source_type", "is_medical", "medical_class_name").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------------------------------ schemas and summaries


@register("SELECT doc_id, text, coalesce(lang, NULL) AS lang, 'none' AS collection, 7 AS weight FROM documents")
def default_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return schemas.with_defaults(rows, {"lang": "xx", "collection": "none", "weight": 7})


@register(
    """SELECT doc_id, text, NULL AS lang FROM documents WHERE lang IS NULL UNION ALL
    SELECT doc_id, NULL AS text, lang FROM documents WHERE lang IS NOT NULL"""
)
def schema_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    return schemas.unified(
        [rows.where(F.col("lang").isNull()).select("doc_id", "text"), rows.where(F.col("lang").isNotNull()).select("doc_id", "lang")]
    )


@register("SELECT coalesce(image_status, '') AS value, count(*) AS n FROM singlepanel_records GROUP BY 1")
def image_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.histogram(_single(spark, sf_dir), F.col("image_status"))


@register(
    """SELECT string_agg(value || '=' || n, ' ' ORDER BY value) AS histogram FROM
    (SELECT event_type AS value, count(*) AS n FROM events GROUP BY 1)"""
)
def event_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.transform("entries", lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    rows = summary.histogram_map(table(spark, sf_dir, "events"), F.col("event_type")).select(F.map_entries("histogram").alias("entries"))
    return rows.select(F.array_join(named, " ").alias("histogram"))


@register("SELECT array_to_string(list_sort(list(DISTINCT coalesce(nullif(image_selection_method, ''), 'unrecorded'))), ' ') AS names FROM singlepanel_records")
def selection_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.distinct_names(_single(spark, sf_dir), "image_selection_method").select(F.array_join("names", " ").alias("names"))


@register("SELECT record_id, pmcid FROM singlepanel_records ORDER BY pmcid, record_id LIMIT 50")
def first_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.first_rows(_single(spark, sf_dir).select("record_id", "pmcid"), ["pmcid", "record_id"], 50)


@register(
    """SELECT record_id, list_distinct(image_hrefs) IS NOT NULL AS has_links, len(list_distinct(image_hrefs)) AS n_links,
      nullif(list_filter(image_hrefs, lambda x: trim(x) <> '')[1], '') AS first_link FROM singlepanel_records"""
)
def figure_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.array_distinct("image_hrefs")
    return _single(spark, sf_dir).select(
        "record_id", links.isNotNull().alias("has_links"), F.size(links).cast("bigint").alias("n_links"),
        resolve.first_href(F.col("image_hrefs")).alias("first_link"),
    )


@register(
    """SELECT date_trunc('day', landed_at) AS start, pmcid, count(*) AS n FROM singlepanel_records WHERE landed_at IS NOT NULL GROUP BY 1, 2"""
)
def landed_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figcurate.streaming.incremental import landed_counts

    return landed_counts(_single(spark, sf_dir))


@register(
    """SELECT md5(local_image_path) AS digest, count(*) AS n FROM singlepanel_records GROUP BY 1"""
)
def path_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _single(spark, sf_dir).groupBy(F.md5("local_image_path").alias("digest")).agg(F.count("*").alias("n"))
