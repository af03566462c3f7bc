"""Screening, detection and the final union of both kinds of images, with their routes and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figcurate.functions import text
from figcurate.functions.ids import strip


def screened(figures: DataFrame, score: str, threshold: float = 0.5, mode: str = "recursive", model: str = "") -> DataFrame:
    """``figures`` with their decision: retained at the threshold or above it."""
    kept = text.reaches(F.col(score), threshold)
    return figures.withColumns(
        {
            "screening_score": F.col(score).cast("float"),
            "retained": kept,
            "screening_label": F.when(kept, 1).when(~kept, 0).cast("tinyint"),
            "screening_threshold": F.lit(float(threshold)),
            "screening_reference_mode": F.lit(mode),
            "screening_model": F.lit(model),
        }
    )


def retained_only(df: DataFrame) -> DataFrame:
    """Rows marked as retained; all rows if there is no such column."""
    return df.where(F.col("retained").eqNullSafe(F.lit(True))) if "retained" in df.columns else df


def detected(figures: DataFrame, score: str, usable: Column, threshold: float = 0.5, positive: int = 1, model: str = "") -> DataFrame:
    """``figures`` with the detector's label; rows that are not usable, or have no score, stay undecided (null)."""
    ok = F.coalesce(usable, F.lit(False))
    value = F.when(ok, F.col(score))
    label = text.label_above(value, threshold, positive)
    status = (
        F.when(~ok, F.lit("skipped_image_not_ready")).when(value.isNull(), F.lit("decode_failed")).otherwise(F.lit("classified"))
    )
    return figures.withColumns(
        {
            "multipanel_score": value.cast("float"),
            "multipanel_label": label.cast("tinyint"),
            "is_multipanel": label == 1,
            "detection_status": status,
            "detection_threshold": F.lit(float(threshold)),
            "detection_positive_label": F.lit(positive).cast("tinyint"),
            "detection_model": F.lit(model),
        }
    )


def routes(df: DataFrame, decision: str) -> dict[str, DataFrame]:
    """All rows, those decided positively and those decided negatively; undecided rows are in neither of the last two."""
    return {
        "all": df,
        "positive": df.where(F.col(decision).eqNullSafe(F.lit(True))),
        "negative": df.where(F.col(decision).eqNullSafe(F.lit(False))),
    }


_SHARED = ("pmcid", "article_version", "resolved_article_version", "pmid", "article_title", "journal_title", "license",
           "figure_id", "figure_label")


def _shared(df: DataFrame) -> dict[str, Column]:
    """The columns both sources have in common, empty where a source lacks them."""
    return {c: text.text_or_empty(F.col(c)) if c in df.columns else F.lit("") for c in _SHARED}


def from_single_panels(figures: DataFrame) -> DataFrame:
    """Candidates from figures of one panel: the whole caption belongs to the image."""
    image = text.single_image_id(*(F.col(c) for c in ("pmcid", "selected_image_href", "local_image_path", "figure_id")))
    empty = F.array().cast("array<string>")
    return figures.select(
        F.lit("single_panel").alias("source_type"),
        *(v.alias(k) for k, v in _shared(figures).items()),
        image.alias("image_id"),
        image.alias("parent_image_id"),
        F.lit(None).cast("bigint").alias("subfigure_index"),
        text.text_or_empty(F.col("local_image_path")).alias("local_image_path"),
        text.text_or_empty(F.col("selected_image_href")).alias("selected_image_href"),
        text.text_or_empty(F.col("caption")).alias("caption"),
        text.text_or_empty(F.col("caption")).alias("main_caption"),
        F.coalesce("reference_texts", empty).alias("reference_texts"),
        F.lit("singlepanel_classified").alias("upstream_status"),
        text.text_or_empty(F.col("detection_model")).alias("upstream_model"),
        F.col("multipanel_score").cast("double").alias("upstream_score"),
    )


def from_subfigures(panels: DataFrame) -> DataFrame:
    """Candidates from panels: the subcaption belongs to the image, the parent's caption is kept beside it."""
    def first(*names: str) -> Column:
        return F.coalesce(*(F.nullif(text.text_or_empty(F.col(n)), F.lit("")) for n in names), F.lit(""))

    empty = F.array().cast("array<string>")
    return panels.select(
        F.lit("subfigure").alias("source_type"),
        *(v.alias(k) for k, v in _shared(panels).items()),
        first("image_id", "panel_image_id").alias("image_id"),
        text.text_or_empty(F.col("parent_image_id")).alias("parent_image_id"),
        F.col("subfigure_index").cast("bigint").alias("subfigure_index"),
        text.text_or_empty(F.col("local_panel_path")).alias("local_image_path"),
        text.text_or_empty(F.col("selected_image_href")).alias("selected_image_href"),
        text.text_or_empty(F.col("subcaption")).alias("caption"),
        first("main_caption", "caption").alias("main_caption"),
        F.coalesce("reference_texts", empty).alias("reference_texts"),
        F.lit("caption_aligned").alias("upstream_status"),
        text.text_or_empty(F.col("caption_model")).alias("upstream_model"),
        F.col("panel_confidence").cast("double").alias("upstream_score"),
    )


def single_panel_is_eligible() -> Column:
    """Whether a figure goes on as a candidate: its image is there and it was found to have one panel (not known does not count)."""
    ready = (F.col("image_status") == "ready") & (F.col("detection_status") == "classified") & (F.col("is_multipanel") == F.lit(False))
    return F.coalesce(ready & (F.col("local_image_path") != ""), F.lit(False))


def subfigure_is_eligible() -> Column:
    """Whether a panel goes on as a candidate: its crop is there and it has a part of the caption that is not blank."""
    ready = (F.col("crop_status") == "ready") & (F.col("caption_alignment_status") == "aligned") & (F.col("local_panel_path") != "")
    return F.coalesce(ready & (strip(F.col("subcaption")) != ""), F.lit(False))


def candidates(figures: DataFrame | None, panels: DataFrame | None) -> DataFrame:
    """All candidates of one or both sources; which rows qualify is the caller's filter."""
    parts = [f(df) for f, df in ((from_single_panels, figures), (from_subfigures, panels)) if df is not None]
    if not parts:
        raise ValueError("no source given")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def classified(df: DataFrame, score: str, threshold: float = 0.5, positive: int = 1, names: tuple[str, str] = ("negative", "positive")) -> DataFrame:
    """Candidates with the final model's label, its name and the decision; no score leaves them undecided."""
    if positive not in (0, 1):
        raise ValueError("the positive label is 0 or 1")
    label = text.label_above(F.col(score), threshold, positive)
    return df.withColumns(
        {
            "medical_score": F.col(score).cast("float"),
            "medical_label": label.cast("tinyint"),
            "medical_class_name": F.when(label == positive, F.lit(names[1])).when(label.isNotNull(), F.lit(names[0])),
            "is_medical": label == positive,
            "medical_classification_status": F.when(label.isNull(), F.lit("decode_failed")).otherwise(F.lit("classified")),
            "medical_threshold": F.lit(float(threshold)),
            "medical_positive_label": F.lit(positive).cast("tinyint"),
        }
    )
