"""The fixed schemas of the stages (column names and types are fixed values, shared with data written by other tools)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(), "l": T.LongType(), "i": T.IntegerType(), "h": T.ShortType(), "b": T.ByteType(), "d": T.DoubleType(),
    "f": T.FloatType(), "t": T.BooleanType(), "L": T.ArrayType(T.StringType()),
}


def _schema(text: str) -> T.StructType:
    """``kind: name name`` lines to a schema."""
    fields = []
    for line in text.strip().splitlines():
        kind, _, names = line.strip().partition(": ")
        fields += [T.StructField(name, _TYPES[kind]) for name in names.split()]
    return T.StructType(fields)


FIGURE_TEXT = _schema(
    """
    s: pmcid article_version pmid article_title journal_title license figure_id figure_label caption
    L: reference_texts reference_texts_screening image_hrefs
    s: source_xml
    """
)
SCREENED = T.StructType(
    FIGURE_TEXT.fields
    + _schema(
        """
        f: screening_score
        b: screening_label
        t: retained
        s: screening_model screening_reference_mode
        d: screening_threshold
        i: screening_max_length
        b: screening_positive_label
        """
    ).fields
)
IMAGE_FIELDS = _schema(
    """
    s: resolved_article_version article_resolution_method
    h: article_candidate_versions
    s: article_metadata_key
    t: article_is_retracted
    s: article_metadata_license selected_image_href image_selection_method
    h: image_candidate_count
    s: image_href_match_type image_s3_url image_s3_key image_expected_md5 local_image_path image_status image_transfer image_error
    i: image_width image_height
    s: image_format image_mode image_md5
    """
)
IMAGE_MANIFEST = T.StructType(SCREENED.fields + IMAGE_FIELDS.fields)
DETECTION_FIELDS = _schema(
    """
    f: multipanel_score
    b: multipanel_label
    t: is_multipanel
    s: detection_status detection_error detection_model detection_architecture
    d: detection_threshold
    i: detection_image_size
    b: detection_positive_label
    """
)
DETECTION = T.StructType(IMAGE_MANIFEST.fields + DETECTION_FIELDS.fields)
PANEL = _schema(
    """
    s: source_type pmcid article_version resolved_article_version pmid figure_id figure_label caption
    L: reference_texts
    s: selected_image_href parent_image_id parent_local_image_path
    l: parent_image_width parent_image_height
    d: multipanel_score
    l: multipanel_label
    t: is_multipanel
    l: detector_index spatial_index historical_order_index
    s: ordering_method
    d: ordering_y_threshold
    l: subfigure_index
    s: image_id panel_image_id identifier_convention
    l: panel_class_id
    s: panel_class_name
    d: panel_confidence box_x1 box_y1 box_x2 box_y2 box_x1_normalized box_y1_normalized box_x2_normalized box_y2_normalized
    s: local_panel_path
    l: panel_width panel_height
    s: panel_format panel_md5 crop_method
    d: crop_gain
    l: crop_pad
    t: crop_square
    s: crop_status crop_error separation_model separation_checkpoint
    d: separation_confidence_threshold
    s: separation_device
    """
)
ALIGNMENT_FIELDS = _schema(
    """
    s: main_caption subcaption caption_alignment_status caption_alignment_error caption_model caption_backend caption_engine
    s: caption_chat_template caption_prompt_version caption_prompt_style
    l: caption_session_len caption_max_new_tokens caption_generation_attempts
    t: caption_retried_after_truncation
    s: subfigure_order_source caption_run_kind caption_source_run_dir
    """
)
PARENT = _schema(
    """
    s: pmcid article_version resolved_article_version pmid figure_id figure_label parent_image_id parent_local_image_path
    d: multipanel_score
    l: panel_count
    s: separation_status separation_error separation_model separation_checkpoint separation_device
    d: separation_confidence_threshold
    s: crop_method source_type
    """
)
OUTPUT = _schema(
    """
    s: source_type pmcid article_version resolved_article_version pmid article_title journal_title license figure_id
    s: figure_label image_id parent_image_id
    l: subfigure_index
    s: local_image_path selected_image_href caption main_caption
    L: reference_texts
    s: upstream_status upstream_model
    d: upstream_score
    f: medical_score
    b: medical_label
    s: medical_class_name
    t: is_medical
    s: medical_classification_status medical_classification_error medical_model medical_architecture
    d: medical_threshold
    b: medical_positive_label
    i: medical_image_size
    """
)
FILE_LIST = _schema(
    """
    s: pmcid license
    t: retracted
    s: article_file citation pmid last_updated
    """
)
ARTICLE_METADATA = T.StructType(
    [
        T.StructField("pmcid", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("license_code", T.StringType()),
        T.StructField("is_retracted", T.BooleanType()),
        T.StructField("is_pmc_openaccess", T.BooleanType()),
        T.StructField("title", T.StringType()),
        T.StructField("pmid", T.StringType()),
        T.StructField("xml_url", T.StringType()),
        T.StructField("media_urls", T.ArrayType(T.StringType())),
    ]
)


class MissingColumns(ValueError):
    """Columns that an operator needs are not there."""


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order and types; columns that are not there are null."""
    present = set(df.columns)
    return df.select(
        *((F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add columns that are not there with their default; nulls of existing columns stay."""
    return df.withColumns({name: F.lit(value) for name, value in defaults.items() if name not in df.columns})


def extended(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that are not there as typed nulls; an existing column keeps its type and place."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns})


def unified(frames: list[DataFrame]) -> DataFrame:
    """All rows under the union of all columns; the same name with different types is an error of the analyser."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
