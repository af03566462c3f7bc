"""Matching figures' links to media files and choosing article versions, as joins.

Nothing loops over articles: links and media are exploded once, joined on (article, name), and every choice is an aggregate of
an ordered struct, so partial results are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figcurate.functions import text
from figcurate.functions.ids import strip

BASENAME, STEM = "basename", "stem"


def first_href(hrefs: Column) -> Column:
    """The first link that is not blank: the primary graphic in document order; null if there is none."""
    return F.try_element_at(F.filter(hrefs, lambda h: strip(h) != ""), F.lit(1))


def _named(rows: DataFrame, column: str, *more: Column | str) -> DataFrame:
    """``rows`` (columns ``more``) under the full name and under the stem of an address, as ``kind`` and ``name``."""
    once = rows.where(strip(F.col(column)) != "").withColumn("_name", text.media_basename(F.col(column)))
    names = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("_name").alias("name")),
        F.struct(F.lit(1).alias("kind"), text.stem_of_name(F.col("_name")).alias("name")),
    )
    return once.select(*more, F.explode(names).alias("_n")).select("*", "_n.kind", "_n.name").drop("_n")


def _best_media(media: DataFrame, article: list[str]) -> DataFrame:
    """(article, kind, name, rank, url): of the media files of one name the one that is preferred."""
    named = _named(media, "url", *article, "url", text.rank_of_name(F.col("_name")).alias("rank"))
    best = named.groupBy(*article, "kind", "name").agg(F.min(F.struct("rank", "url")).alias("best"))
    return best.select(*article, "kind", "name", "best.rank", "best.url")


def match_links(links: DataFrame, media: DataFrame, article: list[str], figure: list[str]) -> DataFrame:
    """The best media file of each figure.

    ``links`` has the article and figure columns, ``at`` (place in the document) and ``href``; ``media`` has the article
    columns and ``url``.  A full name in any link goes before a stem in any link, then the earlier link, the preferred suffix,
    and the smaller address.  Figures without a match have no row.
    """
    met = _named(links, "href", *article, *figure, "at", "href").join(_best_media(media, article), [*article, "kind", "name"])
    best = F.min(F.struct("kind", "at", "rank", "url", "href")).alias("best")
    kind = F.when(F.col("best.kind") == 0, F.lit(BASENAME)).otherwise(F.lit(STEM))
    return met.groupBy(*article, *figure).agg(best).select(
        *article, *figure, F.col("best.href").alias("href"), F.col("best.url").alias("media_url"), kind.alias("match_type")
    )


def candidate_counts(links: DataFrame, media: DataFrame, article: list[str], figure: list[str]) -> DataFrame:
    """How many different media files the links of a figure match, each link taking its best one."""
    each = match_links(links, media, article, [*figure, "at"])
    return each.groupBy(*article, *figure).agg(F.countDistinct("media_url").alias("candidates"))


def version_coverage(figures: DataFrame, media: DataFrame) -> DataFrame:
    """(article, version, coverage): how many figures' primary links a version's media hold.

    ``figures``: article, figure, href (null if the figure has none); ``media``: article, version, url.
    """
    versions = media.select("article", "version").distinct()
    links = _named(figures.where(F.col("href").isNotNull()), "href", "article", "figure")
    held = _named(media, "url", "article", "version").distinct()
    found = links.join(held, ["article", "kind", "name"]).groupBy("article", "version").agg(F.countDistinct("figure").alias("coverage"))
    return versions.join(found, ["article", "version"], "left").select("article", "version", F.coalesce("coverage", F.lit(0)).alias("coverage"))


def resolve_versions(figures: DataFrame, media: DataFrame, declared: DataFrame) -> DataFrame:
    """(article, version, method, candidates, coverage): the version whose media fit the article's figures best.

    ``declared``: article and the version number it states (null if none).  The declared version wins if it covers every
    figure (figures without a link count as not covered); else the greatest coverage, then the greatest version number.
    Articles without any version have method ``metadata_not_found``.
    """
    wanted = figures.groupBy("article").agg(F.count("*").alias("n_figures"))
    scored = version_coverage(figures, media).join(declared, "article", "left")
    full = F.col("n_figures") == F.col("coverage")
    rated = scored.join(wanted, "article").withColumn(
        "exact", F.coalesce((F.col("declared") == F.col("version")) & full, F.lit(False))
    )
    best = rated.groupBy("article").agg(
        F.max(F.struct("exact", "coverage", "version")).alias("best"), F.count("*").alias("candidates")
    )
    method = (
        F.when(F.col("best").isNull(), F.lit("metadata_not_found"))
        .when(F.col("best.exact"), F.lit("explicit_version"))
        .when(F.col("best.coverage") > 0, F.lit("media_match"))
        .otherwise(F.lit("latest_version_no_media_match"))
    )
    return wanted.join(best, "article", "left").select(
        "article",
        F.col("best.version").alias("version"),
        method.alias("method"),
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.coalesce("best.coverage", F.lit(0)).alias("coverage"),
    )


def prepare_images(figures: DataFrame, metadata: DataFrame, keys: list[str]) -> DataFrame:
    """Figures with their article's metadata and primary image, and where that failed.

    ``figures``: ``keys`` (unique), article, declared, hrefs; ``metadata``: article, version, media_urls, license_code, is_retracted.
    The status columns tell only what the data lack; fetching the files is left to ``sources.fetch``.
    """
    flat = figures.select(*keys, "article", "declared", first_href(F.col("hrefs")).alias("href"))
    media = metadata.select("article", "version", F.explode("media_urls").alias("url"))
    names = flat.select("article", F.concat_ws("\x1f", *keys).alias("figure"), "href")
    first = flat.groupBy("article").agg(F.min("declared").alias("declared"))
    catalog = metadata.select("article", "version").distinct().withColumn("url", F.lit(""))
    chosen = resolve_versions(names, media.unionByName(catalog), first).withColumnRenamed("version", "resolved_version")
    about = metadata.select("article", F.col("version").alias("resolved_version"), "license_code", "is_retracted", "media_urls")
    links = names.join(chosen.select("article", "resolved_version"), "article").select(
        "article", "figure", F.lit(0).alias("at"), "href"
    )
    own = about.join(chosen.select("article", "resolved_version"), ["article", "resolved_version"]).select(
        "article", F.explode("media_urls").alias("url")
    )
    hits = match_links(links, own, ["article"], ["figure"]).drop("href")
    status = (
        F.when(F.col("method") == "metadata_not_found", F.lit("metadata_not_found"))
        .when(F.col("href").isNull(), F.lit("missing_image_href"))
        .when(F.col("media_url").isNull(), F.lit("missing_from_metadata"))
        .otherwise(F.lit("found"))
    )
    return (
        flat.withColumn("figure", F.concat_ws("\x1f", *keys))
        .join(chosen, "article", "left")
        .join(about.drop("media_urls"), ["article", "resolved_version"], "left")
        .join(hits, ["article", "figure"], "left")
        .select(
            *keys, "article", "resolved_version", "method", "candidates", "license_code", "is_retracted", "href", "media_url",
            "match_type", status.alias("image_status"),
        )
    )
