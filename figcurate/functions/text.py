"""Scalar expressions on text, licences, article versions, media names and predictions.

Everything here is a Column built from Spark's own functions, so it stays inside generated code.  Python's notions of white
space and decimal digits are kept (Java's are narrower), see ``ids.PYWS``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from figcurate.functions.ids import PYWS, percent_decoded, strip

#: Licence codes with the markers that select them, in the order in which they are tried (fixed values).
LICENSE_MARKERS = (
    ("CC BY-NC-ND", ("BY-NC-ND", "BY NC ND")),
    ("CC BY-NC-SA", ("BY-NC-SA", "BY NC SA")),
    ("CC BY-ND", ("BY-ND", "BY ND")),
    ("CC BY-SA", ("BY-SA", "BY SA")),
    ("CC BY-NC", ("BY-NC", "BY NC")),
    ("CC0", ("CC0", "PUBLIC DOMAIN DEDICATION")),
    ("CC BY", ("CC BY", "/BY/")),
)
NO_LICENSE = "NO-CC CODE"
NO_LICENSE_WORDS = ("NO CC CODE", "NONE", "NULL", "N/A")
#: Licences accepted when no list is given (fixed values).
OPEN_LICENSES = ("CC BY", "CC BY-NC", "CC BY-NC-SA", "CC0", "CC BY-SA")

#: Raster suffixes in the order of preference among copies of one image (fixed values).
RASTER_SUFFIXES = (".jpg", ".jpeg", ".png", ".tif", ".tiff", ".gif", ".webp", ".bmp")


def text_or_empty(col: Column) -> Column:
    """The text of a value, empty for null."""
    return F.coalesce(col.cast("string"), F.lit(""))


def clean_text(col: Column) -> Column:
    """White space runs as one space, none at the ends; empty for null."""
    return F.coalesce(strip(F.regexp_replace(col, f"{PYWS}+", " ")), F.lit(""))


# licences


#: (code, texts that name it as a whole, marks that name it anywhere), tried in order; the most restrictive codes come first.
LICENSE_RULES = (
    (NO_LICENSE, NO_LICENSE_WORDS, (NO_LICENSE,)),
    ("TDM", ("TDM",), ()),
    *((code, (), marks) for code, marks in LICENSE_MARKERS),
)


def canonical_license(col: Column) -> Column:
    """The licence code a free text names; the upper-cased text if it names none, null for null and blank."""
    upper = F.replace(F.regexp_replace(F.upper(strip(col)), f"{PYWS}+", " "), F.lit("_"), F.lit("-"))
    out = F.when(upper == "", F.lit(None).cast("string"))
    for code, whole, marks in LICENSE_RULES:
        tests = [upper.isin(*whole)] if whole else []
        out = out.when(reduce(or_, tests + [upper.contains(mark) for mark in marks]), F.lit(code))
    return out.otherwise(upper)


def canonical_license_text(value: str | None) -> str | None:
    """What ``canonical_license`` gives for a single value, by the same rules."""
    spelled = re.sub(r"\s+", " ", (value or "").strip()).upper().translate({ord("_"): "-"})
    named = (code for code, whole, marks in LICENSE_RULES if spelled in whole or any(mark in spelled for mark in marks))
    return next(named, spelled or None)


def allowed_licenses(value: str | Iterable[str] | None) -> frozenset[str]:
    """An allow list from a comma-separated text or several values; none given means the open ones, an empty text none."""
    if value is None:
        return frozenset(OPEN_LICENSES)
    items = value.split(",") if isinstance(value, str) else value
    return frozenset(code for item in items if (code := canonical_license_text(item)))


def license_allowed(col: Column, allowed: str | Iterable[str] | None = None) -> Column:
    """Whether the licence is on the list; false for null."""
    return F.coalesce(canonical_license(col).isin(*sorted(allowed_licenses(allowed))), F.lit(False))


# article ids and versions


def pmcid_anywhere(col: Column) -> Column:
    """The first article id standing as a word in a text, else its digits after ``PMC``; null if it has no digits."""
    found = F.regexp_extract(col, r"(?i)\bPMC\p{Nd}+\b", 0)
    digits = F.regexp_replace(col, r"[^\p{Nd}]", "")
    return F.when(found != "", F.upper(found)).when(digits != "", F.concat(F.lit("PMC"), digits))


def pmcid_of(value: str | None) -> str:
    """What ``pmcid_anywhere`` gives for a single value; empty if it has no digits."""
    word = re.search(r"\bPMC\d+\b", value or "", re.IGNORECASE)
    number = "".join(filter(str.isdecimal, value or ""))
    return word[0].upper() if word else number and f"PMC{number}"


def pmcid_prefix(col: Column) -> Column:
    """The first ``PMC`` and digits in a text, whatever stands around them; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.upper(strip(col)), r"PMC\p{Nd}+", 0), F.lit(""))


def versioned_pmcid(pmcid: Column, version: Column) -> Column:
    """``PMC12.3`` from an article id and a version spelled ``PMC12.3``, ``3`` or with a final ``.3``; empty if unknown."""
    article, raw = pmcid_prefix(pmcid), F.coalesce(F.upper(strip(version.cast("string"))), F.lit(""))
    number = F.coalesce(
        F.nullif(F.regexp_extract(raw, r"^([0-9]+)$", 1), F.lit("")), F.nullif(F.regexp_extract(raw, r"\.([0-9]+)$", 1), F.lit(""))
    )
    plain = F.regexp_replace(number, "^0+(?=[0-9])", "")
    return F.when((article != "") & plain.isNotNull(), F.concat(article, F.lit("."), plain)).otherwise(F.lit(""))


def version_number(col: Column) -> Column:
    """The version of ``PMC12.3`` as bigint, -1 if it has none."""
    return F.coalesce(F.regexp_extract(strip(col), r"(?i)^PMC[0-9]+\.([0-9]+)$", 1).try_cast("bigint"), F.lit(-1).cast("bigint"))


# urls and media names


def object_url(col: Column) -> Column:
    """struct<bucket, key, md5> of an ``s3://`` address, null if it is none; the digest comes from the query, lower-cased."""
    rest = r"^s3://([^/?#]+)(/[^?#]*)(?:\?([^#]*))?"
    bucket, path = F.regexp_extract(col, rest, 1), F.regexp_extract(col, rest, 2)
    md5 = F.lower(F.regexp_extract(F.regexp_extract(col, rest, 3), r"(?:^|&)md5=([^&]*)", 1))
    value = F.struct(bucket.alias("bucket"), percent_decoded(F.regexp_replace(path, "^/+", "")).alias("key"), md5.alias("md5"))
    return F.when((bucket != "") & (path != ""), value)


def _last_segment(path: Column) -> Column:
    """The name at the end of a path; trailing slashes and ``.`` segments do not count."""
    return F.regexp_extract(F.regexp_replace(path, r"(?:^|(?<=/))\.(?:/+|$)", ""), "([^/]+)/*$", 1)


def media_basename(col: Column) -> Column:
    """The file name of a link or path, decoded and in lower case; a query is cut off only behind a scheme."""
    scheme = "^[A-Za-z][A-Za-z0-9+.-]*:"
    path = F.when(col.rlike(scheme), F.regexp_extract(col, scheme + "(?://[^/?#]*)?([^?#]*)", 1)).otherwise(col)
    return F.lower(F.coalesce(_last_segment(percent_decoded(path)), F.lit("")))


def _raster_pattern(suffixes: Iterable[str]) -> str:
    return "(?i)(?:" + "|".join(s.replace(".", r"\.") for s in sorted(suffixes, key=lambda s: -len(s))) + ")$"


def media_stem(col: Column) -> Column:
    """The file name without one known raster suffix; figure suffixes such as ``.f1`` stay."""
    return stem_of_name(media_basename(col))


def stem_of_name(name: Column) -> Column:
    """``media_stem`` for what ``media_basename`` gave."""
    return F.regexp_replace(name, _raster_pattern(RASTER_SUFFIXES), "")


def media_rank(url: Column) -> Column:
    """The place of a copy's suffix in the order of preference; others come last."""
    return rank_of_name(media_basename(url))


def rank_of_name(name: Column) -> Column:
    """``media_rank`` for what ``media_basename`` gave."""
    suffix = F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)
    out = F.when(suffix == RASTER_SUFFIXES[0], 0)
    for rank, name in enumerate(RASTER_SUFFIXES[1:], 1):
        out = out.when(suffix == name, rank)
    return out.otherwise(len(RASTER_SUFFIXES) + 1)


def is_raster(col: Column) -> Column:
    return F.coalesce(col.rlike(_raster_pattern(RASTER_SUFFIXES)), F.lit(False))


def graphic_id(col: Column, suffixes: Iterable[str] = RASTER_SUFFIXES) -> Column:
    """The name of a graphic: decoded, cut at ``?`` and ``#``, without its folder and one raster suffix; case is kept."""
    bare = F.regexp_replace(percent_decoded(text_or_empty(col)), r"(?s)[?#].*$", "")
    return F.regexp_replace(_last_segment(bare), _raster_pattern(suffixes), "")


def _first_given(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(text_or_empty(c), F.lit("")) for c in columns), F.lit(""))


def parent_image_id(pmcid: Column, href: Column, path: Column, figure: Column) -> Column:
    """Article and graphic joined by ``_``; ``.bmp`` is kept; the figure id, then ``figure``, stands in for the graphic."""
    graphic = graphic_id(_first_given(href, path, figure), [s for s in RASTER_SUFFIXES if s != ".bmp"])
    article = text_or_empty(pmcid)
    other = F.coalesce(F.nullif(text_or_empty(figure), F.lit("")), F.lit("figure"))
    return F.concat(article, F.lit("_"), F.when((article != "") & (graphic != ""), graphic).otherwise(other))


def single_image_id(pmcid: Column, href: Column, path: Column, figure: Column) -> Column:
    """Like ``parent_image_id`` but without ``.bmp`` and, for a missing article id, without the leading ``_``."""
    graphic = F.nullif(graphic_id(_first_given(href, path, figure)), F.lit(""))
    name = F.coalesce(graphic, F.nullif(text_or_empty(figure), F.lit("")), F.lit("figure"))
    return F.concat(F.when(text_or_empty(pmcid) != "", F.concat(pmcid, F.lit("_"))).otherwise(F.lit("")), name)


def subfigure_id(parent: Column, index: Column) -> Column:
    return F.concat(parent, F.lit("_"), index.cast("bigint").cast("string"))


def rooted_path(path: Column, root: Column | str) -> Column:
    """A path as it is if absolute, else below ``root``."""
    base = F.lit(root) if isinstance(root, str) else root
    joined = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), path)
    return F.when(path.startswith("/"), path).otherwise(joined)


# prompts and predictions

DELIMITER = "||"
IMAGE_TOKEN = "<IMAGE_TOKEN>"
#: The instruction of the caption model, which was trained with these words (fixed value).
INSTRUCTION = (
    "Your task is to separate the given caption into subcaptions. "
    "You are provided with a compound figure, ", " subfigures, and a main caption. "
    "For each subfigure, extract the corresponding subcaption from the main caption and separate them using \"||\". "
    "Make sure the number and order of subcaptions match the given subfigures.",
)


def screening_references(override: Column, references: Column, recursive: bool = True) -> Column:
    """The reference texts used for screening: the override where there is one (an empty one counts), else the clean texts."""
    empty = F.array().cast("array<string>")
    return F.coalesce(override, references, empty) if recursive else F.coalesce(references, empty)


def screening_input(caption: Column, references: Column) -> Column:
    """The two quoted fields that the text classifier reads."""
    joined = F.coalesce(F.array_join(references, "\n"), F.lit(""))
    return F.concat(F.lit('"Caption": '), text_or_empty(caption), F.lit('\n"Reference Text": '), joined)


def caption_prompt(caption: Column, panels: Column, image_token: str | None = IMAGE_TOKEN) -> Column:
    """The request to the caption model for a parent of ``panels`` panels; null for fewer than one.

    With ``image_token`` each image has its place in the text; without it the order of the images is told in words.
    """
    n = panels.cast("string")
    head = F.concat(F.lit(INSTRUCTION[0]), n, F.lit(INSTRUCTION[1] + "\n\n"))
    if image_token:
        blocks = F.array_join(F.array_repeat(F.lit(f"# Subfigure\n{image_token}"), panels.cast("int")), "\n")
        middle = F.concat(F.lit(f"# Compound Figure\n{image_token}\n"), blocks, F.lit("\n"))
    else:
        middle = F.concat(
            F.lit("The images are provided in this exact order: the compound figure first, followed by subfigures 0 through "),
            (panels.cast("int") - 1).cast("string"),
            F.lit(".\n"),
        )
    return F.when(panels >= 1, F.concat(head, middle, F.lit("# Main Caption\n"), text_or_empty(caption)))


def unfenced(prediction: Column) -> Column:
    """A prediction without white space at its ends and without a code fence around two lines or more."""

    def bare(text: Column) -> Column:
        first = F.instr(text, "\n")
        after_last = F.instr(F.reverse(text), "\n")
        inner = F.substring(text, first + 1, F.greatest(F.length(text) - after_last - first, F.lit(0)))
        fenced = text.startswith("```") & text.endswith("```") & (first > 0)
        return F.when(fenced, strip(inner)).otherwise(text)

    return _once(F.coalesce(strip(prediction), F.lit("")), bare)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def subcaptions(prediction: Column) -> Column:
    """The parts of a prediction, stripped; blank parts are kept, a blank prediction has none."""

    def parts(text: Column) -> Column:
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(text, r"\|\|", -1), strip))

    return _once(unfenced(prediction), parts)


def prediction_status(parts: Column, expected: Column, finish_reason: Column) -> Column:
    """How a prediction fits its parent; the first that applies: cut off, empty, another count, a blank part, aligned."""
    return (
        F.when(F.lower(F.coalesce(finish_reason, F.lit(""))) == "length", F.lit("generation_truncated"))
        .when(F.coalesce(F.size(parts), F.lit(0)) == 0, F.lit("empty_prediction"))
        .when(F.size(parts) != expected, F.lit("count_mismatch"))
        .when(F.exists(parts, lambda p: p == ""), F.lit("empty_subcaption"))
        .otherwise(F.lit("aligned"))
    )


# scores


def positive_share(logits: Column, positive: int = 1) -> Column:
    """Softmax probability of one class of an array of logits, in double precision."""
    z = F.transform(logits, lambda x: x.cast("double"))
    top = F.array_max(z)
    total = F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
    return F.exp(F.element_at(z, positive + 1) - top) / total


def label_above(score: Column, threshold: float, positive: int = 1) -> Column:
    """The positive label strictly above the threshold, the other one at or below it, null for null."""
    return F.when(score > F.lit(float(threshold)), positive).when(score.isNotNull(), 1 - positive)


def reaches(score: Column, threshold: float) -> Column:
    """Whether a score is at the threshold or above it."""
    return score >= F.lit(float(threshold))
