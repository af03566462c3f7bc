"""Canonical article, image, version and path identifiers as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's white space, spelled out because Java's ``\s`` lacks most of it (fixed values).
PYWS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


#: The same characters, to be taken off at the ends of a value.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(col: Column) -> Column:
    """Remove all Unicode white space at both ends; looks at the ends only."""
    return F.btrim(col, F.lit(WHITE))


def blank_to_null(col: Column) -> Column:
    """Null for null, empty and blank values, otherwise the stripped value."""
    return F.nullif(strip(col), F.lit(""))


def canonical_pmcid(col: Column) -> Column:
    """``PMC`` and the digits of an article id however it is spelled; null if it has no digits."""
    digits = F.regexp_extract(col, "([0-9]+)", 1)
    return F.when(digits != "", F.concat(F.lit("PMC"), digits))


def version_of(col: Column) -> Column:
    """The version number of ``PMC12.3``, ``.3`` or ``3`` as bigint (leading zeros do not matter); null if there is none."""
    return F.regexp_extract(col, rf"(?:^|\.){PYWS}*([0-9]+){PYWS}*$", 1).try_cast("bigint")


def current_version(resolved: Column, declared: Column) -> Column:
    """The row's version: that of the resolved value, or of the declared one if the former is null or blank."""
    return version_of(F.coalesce(blank_to_null(resolved), declared))


def canonical_image_id(col: Column) -> Column:
    """An image id without surrounding blanks and without a final ``.jpg`` or ``.png``; null if nothing is left."""
    return blank_to_null(F.regexp_replace(strip(col), r"(?i)\.(jpg|png)$", ""))


def percent_decoded(col: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone and keeps a value whose escapes are malformed."""
    decoded = F.coalesce(F.try_url_decode(F.replace(col, F.lit("+"), F.lit("%2B"))), col)
    return F.when(col.contains("%"), decoded).otherwise(col)


def _resolve_segments(path: Column) -> Column:
    """``/a//b/./c/../d`` as ``/a/b/d``; ``..`` above the root stays at the root."""
    segments = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))
    stack = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(
            F.array_append(acc, s)
        ),
    )
    return F.concat(F.lit("/"), F.array_join(stack, "/"))


def canonical_path(path: Column, root: Column) -> Column:
    """The absolute place a path leads to; relative paths are taken from ``root``; null for null and blank paths.

    Handles ``file:`` prefixes, percent escapes, doubled slashes, ``.`` and ``..`` segments.
    """
    bare = F.regexp_replace(percent_decoded(path), "^file:/+", "/")
    absolute = F.when(bare.startswith("/"), bare).otherwise(F.concat(root, F.lit("/"), bare))
    plain = ~absolute.rlike(r"//|/\.\.?(/|$)|/$")
    resolved = F.when(plain, absolute).otherwise(_resolve_segments(absolute))
    return F.when(strip(path) != "", resolved)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
