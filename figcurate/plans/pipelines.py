"""The stages put together: from articles to screened figures, panels, aligned captions and the final table.

Every function takes and returns DataFrames; models come in as factories (see ``operators.scoring``), files as listings, so the
same plans run on fixtures and on a cluster.  Nothing is written here; ``sources.sinks`` does that with the routes returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figcurate import schemas
from figcurate.functions import text
from figcurate.functions.ids import strip
from figcurate.operators import alignment, candidates, panels, recovery, resolve, scoring
from figcurate.sources import articles, jats

CROP_GAIN, CROP_PAD = 1.02, 10


# stage 1: figures and screening


def extract(files: DataFrame, metadata: DataFrame, key: str, allowed: str | None = None, require_caption: bool = True) -> DataFrame:
    """Figure rows of the articles that neither their metadata nor, where these are silent, their own licence rule out.

    ``files``: path, content and ``key``; ``metadata``: ``key``, license, retracted and what ``jats.METADATA`` names.
    """
    usable = articles.usable_articles(files, metadata, key, allowed)
    names = ("pmcid", "article_version", "pmid", "license", "title")
    known = F.struct(*((F.col(n) if n in usable.columns else F.lit(None).cast("string")).alias(n) for n in names))
    figures = jats.parse_articles(usable.select("path", "content", known.alias("metadata")), require_caption)
    return figures.where(text.license_allowed(F.col("license"), allowed))


def screen(
    figures: DataFrame, factory: Callable[[], scoring.Scorer], threshold: float = 0.5, recursive: bool = True, model: str = "", batch_size: int = 32
) -> dict[str, DataFrame]:
    """All figures with their score and decision, those retained, and those not."""
    references = text.screening_references(F.col("reference_texts_screening"), F.col("reference_texts"), recursive)
    asked = figures.withColumn("_input", text.screening_input(F.col("caption"), references))
    scored = scoring.with_scores(asked, "_input", factory, batch_size, "_score").drop("_input", "score_error")
    decided = candidates.screened(scored, "_score", threshold, "recursive" if recursive else "clean", model).drop("_score")
    return candidates.routes(decided, "retained")


# stage 2: images and detection


def locate_images(figures: DataFrame, metadata: DataFrame) -> DataFrame:
    """Retained figures with their article version and primary image address; ``metadata`` as in ``schemas.ARTICLE_METADATA``."""
    kept = candidates.retained_only(figures)
    about = metadata.select(
        text.pmcid_prefix(F.col("pmcid")).alias("article"), F.col("version").try_cast("bigint").alias("version"), "media_urls",
        "license_code", "is_retracted",
    )
    wanted = kept.select(
        "figure_id", text.pmcid_prefix(F.col("pmcid")).alias("article"),
        text.version_number(text.versioned_pmcid(F.col("pmcid"), F.col("article_version"))).alias("v"), F.col("image_hrefs").alias("hrefs"),
    ).select("figure_id", "article", F.when(F.col("v") >= 0, F.col("v")).alias("declared"), "hrefs")
    found = resolve.prepare_images(wanted, about, ["figure_id"])
    version = F.when(F.col("resolved_version").isNotNull(), F.concat("article", F.lit("."), "resolved_version")).otherwise(F.lit(""))
    address = text.object_url(F.col("media_url"))
    named = found.select(
        "article", "figure_id", version.alias("resolved_article_version"), F.col("method").alias("article_resolution_method"),
        F.col("candidates").cast("smallint").alias("article_candidate_versions"), F.col("is_retracted").alias("article_is_retracted"),
        F.col("license_code").alias("article_metadata_license"), F.col("href").alias("selected_image_href"),
        F.col("match_type").alias("image_href_match_type"), F.col("media_url").alias("image_s3_url"),
        address["key"].alias("image_s3_key"), address["md5"].alias("image_expected_md5"),
        F.concat(F.lit("images/"), version, F.lit("/"), text.media_basename(F.col("media_url"))).alias("local_image_path"), "image_status",
    )
    return kept.withColumn("article", text.pmcid_prefix(F.col("pmcid"))).join(named, ["article", "figure_id"], "left").drop("article")


def detect(figures: DataFrame, image: str, factory: Callable[[], scoring.Scorer], threshold: float = 0.5, model: str = "", batch_size: int = 256) -> dict[str, DataFrame]:
    """All figures with the detector's decision, those of several panels and those of one; ``image`` holds path or bytes."""
    ready = F.col("image_status") == "ready"
    scored = scoring.with_scores(figures.withColumn("_image", F.when(ready, F.col(image))), "_image", factory, batch_size, "_score", "detection_error")
    return candidates.routes(candidates.detected(scored, "_score", ready, threshold, model=model).drop("_image", "_score"), "is_multipanel")


# stage 3: panels

BOX = "detector_index bigint, box_x1 double, box_y1 double, box_x2 double, box_y2 double, panel_confidence double, panel_class_id bigint, panel_class_name string"


def boxes(figures: DataFrame, key: str, image: str, factory: Callable[[], Callable[[Any], list[dict]]]) -> DataFrame:
    """One row per box that a detector finds in each figure's image, with ``separation_error`` for those it fails on.

    The detector takes an image and returns dicts with x1, y1, x2, y2, confidence, class_id and class_name.
    """
    kind = figures.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = factory()
        for batch in batches:
            rows: list[dict] = []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows += [
                        {key: name, "detector_index": i, **{f"box_{c}": float(b[c]) for c in ("x1", "y1", "x2", "y2")},
                         "panel_confidence": b.get("confidence"), "panel_class_id": b.get("class_id"), "panel_class_name": b.get("class_name")}
                        for i, b in enumerate(detector(value))
                    ]
                except Exception as e:
                    rows.append({key: name, "separation_error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([batch.schema.field(0), *_BOX_FIELDS]))

    return figures.select(key, image).mapInArrow(run, f"`{key}` {kind}, {BOX}, separation_error string")


_BOX_FIELDS = [
    pa.field("detector_index", pa.int64()), *(pa.field(f"box_{c}", pa.float64()) for c in ("x1", "y1", "x2", "y2")),
    pa.field("panel_confidence", pa.float64()), pa.field("panel_class_id", pa.int64()), pa.field("panel_class_name", pa.string()),
    pa.field("separation_error", pa.string()),
]


def crop_window(width: Column, height: Column) -> Column:
    """struct<x1, y1, x2, y2> of a panel's crop: its box grown by the gain and the padding, within the image, in whole pixels."""
    def side(low: str, high: str, size: Column) -> tuple[Column, Column]:
        middle, half = (F.col(low) + F.col(high)) / 2, (F.col(high) - F.col(low)) * CROP_GAIN / 2 + CROP_PAD / 2
        return (F.greatest(F.lit(0), F.floor(middle - half)), F.least(size.cast("bigint"), F.floor(middle + half)))

    (x1, x2), (y1, y2) = side("box_x1", "box_x2", width), side("box_y1", "box_y2", height)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def separate(figures: DataFrame, image: str, factory: Callable[[], Callable[[Any], list[dict]]]) -> tuple[DataFrame, DataFrame]:
    """Parents and panels of the figures of several panels; panels are numbered in reading order and conform to PANEL.

    ``figures`` have the columns of DETECTION.  Text, numbers and flags that a figure lacks are empty, zero and false.
    """
    parts = [F.col(c) for c in ("pmcid", "selected_image_href", "local_image_path", "figure_id")]
    keyed = figures.withColumn("parent_image_id", text.parent_image_id(*parts))
    found = boxes(keyed, "parent_image_id", image, factory)
    good = found.where(F.col("detector_index").isNotNull()).drop("separation_error")
    sizes = keyed.select("parent_image_id", F.col("image_width").alias("parent_image_width"), F.col("image_height").alias("parent_image_height"))
    ordered = panels.reading_order(
        good.join(sizes, "parent_image_id"), ["parent_image_id"], "detector_index", "box_x1", "box_y1", "parent_image_width", "parent_image_height"
    )
    width, height = F.col("parent_image_width"), F.col("parent_image_height")
    shares = {
        f"box_{c}_normalized": panels.normalised_box(F.col(f"box_{c}"), width if c[0] == "x" else height) for c in ("x1", "x2", "y1", "y2")
    }
    number = F.col("panel_order")
    crop = crop_window(width, height)
    named = ordered.withColumns(
        {
            **shares, "historical_order_index": number, "spatial_index": number, "subfigure_index": number,
            "image_id": text.subfigure_id(F.col("parent_image_id"), number), "panel_image_id": text.subfigure_id(F.col("parent_image_id"), number),
            "source_type": F.lit("subfigure"), "ordering_y_threshold": F.lit(panels.Y_THRESHOLD), "crop_gain": F.lit(CROP_GAIN),
            "crop_pad": F.lit(CROP_PAD).cast("bigint"), "crop_square": F.lit(False),
            "panel_width": crop["x2"] - crop["x1"], "panel_height": crop["y2"] - crop["y1"],
        }
    )
    about = keyed.select("parent_image_id", "reference_texts", *(text.text_or_empty(F.col(c)).alias(c) for c in (
        "pmcid", "article_version", "resolved_article_version", "pmid", "figure_id", "figure_label", "caption", "selected_image_href")),
        text.text_or_empty(F.col("local_image_path")).alias("parent_local_image_path"),
        F.coalesce(F.col("multipanel_score").cast("double"), F.lit(0.0)).alias("multipanel_score"),
        F.coalesce(F.col("multipanel_label").cast("bigint"), F.lit(0)).alias("multipanel_label"),
        F.coalesce("is_multipanel", F.lit(False)).alias("is_multipanel"))
    panel_rows = schemas.conform(named.join(about, "parent_image_id"), schemas.PANEL)
    counts = good.groupBy("parent_image_id").agg(F.count("*").alias("panel_count"))
    failed = found.where(F.col("separation_error").isNotNull()).select("parent_image_id", "separation_error")
    status = F.when(F.col("separation_error").isNotNull(), F.lit("inference_failed")).when(F.col("panel_count") > 0, F.lit("separated"))
    parents = about.join(counts, "parent_image_id", "left").join(failed, "parent_image_id", "left").withColumns(
        {"separation_status": status.otherwise(F.lit("no_panels_detected")), "panel_count": F.coalesce("panel_count", F.lit(0))}
    )
    return schemas.conform(parents, schemas.PARENT), panel_rows


# stage 4: captions


def align(
    panel_rows: DataFrame, factory: Callable[[], scoring.Backend], run: str, kind: str = "first_pass", only: DataFrame | None = None,
    image_token: str | None = text.IMAGE_TOKEN, max_new_tokens: int = 1024, retry_tokens: int | None = None, batch_size: int = 4,
) -> dict[str, DataFrame]:
    """Predictions for every parent that has panels: parents with their status, aligned panels, and the raw predictions.

    ``panel_rows``: parent_image_id, subfigure_index (0, 1, 2, ...), caption, local_panel_path, parent_local_image_path.  A caption
    is that of the parent's first panel.  ``only`` limits the run to listed parents; an empty list runs none.
    """
    chosen = panel_rows if only is None else alignment.only_listed(panel_rows, only, ["parent_image_id"])
    first = F.min_by("caption", "subfigure_index")
    paths = F.array_sort(F.collect_list(F.struct("subfigure_index", "local_panel_path")))
    parents = chosen.groupBy("parent_image_id").agg(
        first.alias("main_caption"), F.min("parent_local_image_path").alias("parent_path"), paths.alias("panels"), F.count("*").alias("expected")
    )
    images = F.concat(F.array("parent_path"), F.transform("panels", lambda p: p["local_panel_path"]))
    asked = parents.where(strip(F.coalesce("main_caption", F.lit(""))) != "")
    requests = asked.select(
        F.col("parent_image_id").alias("request_id"), text.caption_prompt(F.col("main_caption"), F.col("expected"), image_token).alias("prompt"),
        images.alias("image_paths"),
    )
    answers = scoring.with_predictions(requests, factory, batch_size, max_new_tokens, retry_tokens)
    joined = parents.join(answers.withColumnRenamed("request_id", "parent_image_id"), "parent_image_id", "left")
    judged = alignment.judged(joined.withColumnRenamed("error", "backend_error"), "text", "expected", "finish_reason")
    status = (
        F.when(strip(F.coalesce("main_caption", F.lit(""))) == "", F.lit("missing_main_caption"))
        .when(F.coalesce("backend_error", F.lit("")) != "", F.lit("inference_failed"))
        .otherwise(F.col("status"))
    )
    done = judged.withColumns(
        {
            "status": status, "caption_run_kind": F.lit(kind), "caption_source_run_dir": F.lit(run),
            "error": F.when(F.coalesce("backend_error", F.lit("")) != "", F.col("backend_error")).otherwise(F.col("error")),
        }
    )
    captions = alignment.panel_captions(done, chosen, ["parent_image_id"], "subfigure_index")
    raw = done.select(
        "parent_image_id", F.col("text").alias("raw_prediction"), "status", (F.col("status") == alignment.ALIGNED).alias("retained_in_final_output"),
        F.struct("finish_reason", "generate_token_len", "max_new_tokens", "attempts", "initial_finish_reason", "initial_token_len").alias("backend_metadata"),
    )
    return {
        "parents": done.drop("panels", "parts", "parent_path"),
        "subfigures": captions.withColumns({"caption_run_kind": F.lit(kind), "caption_source_run_dir": F.lit(run)}),
        "raw": raw,
    }


def retry(source: dict[str, DataFrame], panel_rows: DataFrame, factory: Callable[[], scoring.Backend], run: str, statuses: list[str], **options: Any) -> dict[str, DataFrame]:
    """A second run over the parents whose status in ``source`` is one of ``statuses``."""
    wanted = recovery.with_status(source["parents"], "parent_image_id", "status", statuses)
    return align(panel_rows, factory, run, "retry", wanted, **options)


def merge(base: tuple[str, dict[str, DataFrame]], retries: list[tuple[str, dict[str, DataFrame]]], strict: bool = True) -> dict[str, DataFrame]:
    """Base and retry runs as one: parents with the story of their attempts, and the panels and raw rows of the runs that count."""
    runs = recovery.attempts(base[1]["parents"], [(n, r["parents"]) for n, r in retries], base[0])
    merged = recovery.merged(runs, "parent_image_id", "status", strict)

    def children(part: str) -> DataFrame:
        tagged = [r[part].withColumn("run_name", F.lit(n)) for n, r in [base, *retries]]
        return recovery.rows_of_chosen_run(schemas.unified(tagged), merged, "parent_image_id")

    return {
        "parents": merged, "subfigures": children("subfigures"), "raw": children("raw"),
        "transitions": recovery.transitions(runs, "parent_image_id", "status"),
        "replacements": recovery.replacements(runs, "status", [n for n, _ in retries]),
    }


# stage 5: final decision


def classify(
    rows: DataFrame, image: str, factory: Callable[[], scoring.Scorer], threshold: float = 0.5, positive: int = 1,
    names: tuple[str, str] = ("non_medical", "medical"), model: str = "", batch_size: int = 256,
) -> dict[str, DataFrame]:
    """Candidates with the final decision under the output schema, and both routes."""
    scored = scoring.with_scores(rows, image, factory, batch_size, "_score", "medical_classification_error")
    decided = candidates.classified(scored, "_score", threshold, positive, names).withColumn("medical_model", F.lit(model))
    return candidates.routes(schemas.conform(decided, schemas.OUTPUT), "is_medical")
