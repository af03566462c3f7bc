"""One consistent form for text that looks the same but is written in other characters.

Each text is cut at ordinary spaces; words without any character that could change are left alone (most are), and every
distinct remaining word is put in order once: it is exploded to positioned code points, these are joined with the broadcast
tables of forms and look-alikes, combining marks are ordered by class, composed again with their base, and the word is rebuilt.
Texts take their words back by a join on the word.

What changes: forms of another width or style (full and half width, mathematical styles, small and presentation forms),
ligatures, the micro sign, canonical doubles such as the ohm and angstrom signs, accents written apart from a letter with which
a composed letter exists, wrongly ordered accents, invisible characters, spaces and hyphens other than the ordinary, and
look-alike letters of another script in a run of letters that also holds Latin letters (or both Greek and Cyrillic ones).

What stays: super- and subscript digits, dashes, Greek letters as symbols, words wholly of another script, accents without a
composed letter.  Conjoining Hangul is left as it is.

Null and empty texts stay null and empty and are never reported; a word made of invisible characters only becomes empty.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from figcurate.session import shared_checkpoint

#: Letters of other scripts and the Latin letters they look like (fixed values).
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C",
    "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԁ": "D", "Ԛ": "Q", "Ԝ": "W", "Ӏ": "I",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T",
    "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    "ɑ": "a", "ɡ": "g", "ı": "i",
    "Օ": "O", "Տ": "S", "օ": "o", "հ": "h", "ո": "n", "ց": "g", "յ": "j",
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮪ": "S",
    "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p", "Ⲥ": "C", "ⲥ": "c",
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N",
    "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O",
    "ꓴ": "U",
}
#: Kinds of compatibility decompositions that only change width, style or presentation (fixed values).
FORM_KINDS = ("<wide>", "<narrow>", "<font>", "<small>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
#: Invisible characters outside the category of format characters (fixed values).
INVISIBLE = "\u00ad\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
HYPHENS = "\u2010\u2011\u2043\u02d7"
#: Compatibility characters that look like the letter they stand for (fixed values).
LIKE_LETTERS = "µſϐϑϕϖϰϱϴϵϹ"


@lru_cache(maxsize=None)
def _folded(char: str) -> str:
    """The character's form with every accepted decomposition applied, canonically decomposed."""
    if char in INVISIBLE or unicodedata.category(char) == "Cf" or "\ufe00" <= char <= "\ufe0f":
        return ""
    if char in HYPHENS:
        return "-"
    if char in LOOK_ALIKES and char in "ϲϳϹϿ":
        return char
    kind, _, rest = unicodedata.decomposition(char).partition(" ")
    if not kind:
        return char
    if kind.startswith("<"):
        targets = "".join(chr(int(c, 16)) for c in rest.split())
        accepted = (
            kind in FORM_KINDS
            or char in LIKE_LETTERS
            or kind == "<compat>"
            and (targets == " " or "LIGATURE" in unicodedata.name(char, ""))
        )
        return "".join(map(_folded, targets)) if accepted else char
    return "".join(_folded(chr(int(c, 16))) for c in f"{kind} {rest}".split())


@lru_cache(maxsize=1)
def form_table() -> dict[str, str]:
    """Every character whose folded, decomposed form differs from itself (Hangul syllables excepted)."""
    out = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if (form := _folded(char)) != char:
            out[char] = form
    return out


@lru_cache(maxsize=1)
def composition_table() -> dict[str, str]:
    """Pairs of a character and a combining mark, with the letter they compose to."""
    out = {}
    for code in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(code))
        if parts and "<" not in parts and " " in parts and unicodedata.normalize("NFC", chr(code)) == chr(code):
            out["".join(chr(int(c, 16)) for c in parts.split())] = chr(code)
    return out


@lru_cache(maxsize=1)
def _marks() -> dict[str, int]:
    return {chr(c): k for c in range(0x300, sys.maxunicode + 1) if (k := unicodedata.combining(chr(c)))}


@lru_cache(maxsize=1)
def _suspects() -> str:
    """A character class of all that may change: forms that do not compose back to themselves, marks and look-alikes."""
    changing = {c for c, form in form_table().items() if unicodedata.normalize("NFC", form) != c}
    codes = sorted({ord(c) for c in changing} | {ord(c) for c in LOOK_ALIKES} | {ord(c) for c in _marks()})
    ranges: list[list[int]] = []
    for code in codes:
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    inside = "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)
    return rf"(?=[^\x00-\x7F])[{inside}]"  # the long class is tried only where a cheap one holds


def may_change(col: Column) -> Column:
    return col.rlike(_suspects())


def _code_points(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit("(?s)."), 0)


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    forms = spark.createDataFrame(list(form_table().items()), "char string, form string")
    marks = _marks()
    kinds = [(c, marks.get(c, 0), LOOK_ALIKES.get(c)) for c in sorted(marks.keys() | LOOK_ALIKES.keys())]
    return F.broadcast(forms), F.broadcast(spark.createDataFrame(kinds, "char string, class int, alike string"))


def normalise_words(words: DataFrame) -> DataFrame:
    """(word) distinct to (word, fixed); tables of fixed size are broadcast, everything else is keyed by the word."""
    forms, kinds = _tables(words.sparkSession)
    exploded = words.select("word", F.posexplode(_code_points(F.col("word"))).alias("at", "char"))
    folded = exploded.join(forms, "char", "left").select(
        "word", "at", F.posexplode(_code_points(F.coalesce("form", "char"))).alias("sub", "char")
    )
    typed = folded.join(kinds, "char", "left").select(
        "word", "at", "sub", "char", "alike", F.coalesce("class", F.lit(0)).alias("class"),
        F.col("char").rlike(r"^[\p{L}\p{M}]$").alias("letter"),
    )
    order = Window.partitionBy("word").orderBy("at", "sub")
    runs = typed.withColumn("run", F.sum(F.when(F.col("letter"), 0).otherwise(1)).over(order))
    run = Window.partitionBy("word", "run")
    alike = F.col("alike").isNotNull()
    latin = F.max(F.col("letter") & F.col("char").rlike(r"^\p{IsLatin}$") & ~alike).over(run)
    greek = F.max(F.col("letter") & F.col("char").rlike(r"^\p{IsGreek}$")).over(run)
    cyrillic = F.max(F.col("letter") & F.col("char").rlike(r"^\p{IsCyrillic}$")).over(run)
    plain = runs.select(
        "word", "at", "sub", "class", F.when(alike & (latin | (greek & cyrillic)), F.col("alike")).otherwise(F.col("char")).alias("char")
    )
    groups = plain.withColumn("group", F.sum(F.when(F.col("class") == 0, 1).otherwise(0)).over(order))
    ordered = groups.groupBy("word", "group").agg(
        F.array_sort(F.collect_list(F.struct("class", "at", "sub", "char"))).alias("chars")
    )
    rebuilt = ordered.groupBy("word").agg(
        F.array_sort(F.collect_list(F.struct("group", _composed(F.col("chars")).alias("text")))).alias("groups")
    )
    fixed = rebuilt.select("word", F.array_join(F.transform("groups", lambda g: g["text"]), "").alias("fixed"))
    return words.join(fixed, "word", "left").select("word", F.coalesce("fixed", F.lit("")).alias("fixed"))


def _composed(chars: Column) -> Column:
    """The text of a base (class 0, if there is one) and its ordered marks, composed as far as not blocked."""
    pairs = composition_table()
    table = F.map_from_arrays(F.array(*map(F.lit, pairs)), F.array(*map(F.lit, pairs.values())))
    begin = F.struct(F.lit("").alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))

    def step(acc: Column, mark: Column) -> Column:
        joined = F.try_element_at(table, F.concat(acc["base"], mark["char"]))
        free = (acc["rest"] == "") | (acc["last"] < mark["class"])
        return (
            F.when(mark["class"] == 0, F.struct(mark["char"].alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last")))
            .when(free & joined.isNotNull(), F.struct(joined.alias("base"), acc["rest"].alias("rest"), acc["last"].alias("last")))
            .otherwise(
                F.struct(acc["base"].alias("base"), F.concat(acc["rest"], mark["char"]).alias("rest"), mark["class"].alias("last"))
            )
        )

    folded = F.aggregate(chars, begin, step, lambda acc: F.concat(acc["base"], acc["rest"]))
    return F.when(F.size(chars) == 1, chars[0]["char"]).otherwise(folded)


def text_items(records: DataFrame, fields: dict[str, bool]) -> DataFrame:
    """(record_id, text_field, item, text) of the named columns; a column marked True is an array, item counts from 0."""
    out = None
    for name, is_list in fields.items():
        if is_list:
            rows = records.select("record_id", F.lit(name).alias("text_field"), F.posexplode(name).alias("item", "text"))
        else:
            rows = records.select("record_id", F.lit(name).alias("text_field"), F.lit(0).alias("item"), F.col(name).alias("text"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _suspect_words(items: DataFrame) -> DataFrame:
    """Each distinct word of a text that may change."""
    words = F.array_distinct(F.filter(F.split("text", " "), may_change))
    return items.where(may_change(F.col("text"))).select("record_id", "text_field", "item", F.explode(words).alias("word"))


def changed_words(items: DataFrame) -> DataFrame:
    """(record_id, text_field, item, word, fixed) where the word is not in its consistent form."""
    suspects = shared_checkpoint(_suspect_words(items))  # few; read twice
    changed = normalise_words(suspects.select("word").distinct()).where(F.col("word") != F.col("fixed"))
    return suspects.join(changed, "word")


def disguised(items: DataFrame) -> DataFrame:
    """(record_id, text_field) of texts that are not in their consistent form."""
    return changed_words(items).select("record_id", "text_field").distinct()


def normalised(items: DataFrame) -> DataFrame:
    """``items`` with every text in its consistent form and whether it ``changed``."""
    key = ["record_id", "text_field", "item"]
    fixes = (
        changed_words(items)
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_set(F.struct("word", "fixed"))).alias("fixes"))  # a text that comes twice has its words once
    )
    suspect = F.coalesce(may_change(F.col("text")), F.lit(False))
    rest = items.where(~suspect).withColumn("changed", F.lit(False))
    touched = items.where(suspect).join(fixes, key, "left")
    words = F.transform(F.split("text", " "), lambda w: F.coalesce(F.try_element_at("fixes", w), w))
    fixed = F.when(F.col("fixes").isNull(), F.col("text")).otherwise(F.array_join(words, " "))
    return rest.unionByName(touched.select(*key, fixed.alias("text"), F.col("fixes").isNotNull().alias("changed")))


def quick_fold(col: Column) -> Column:
    """A cheaper form for comparisons only: one-to-one forms and look-alikes replaced wherever they stand, invisibles removed."""
    single = {c: f for c, f in {**form_table(), **LOOK_ALIKES}.items() if len(f) == 1}
    gone = [c for c, f in form_table().items() if not f]
    many = {c: f for c, f in form_table().items() if len(f) > 1 and unicodedata.normalize("NFC", f) != c and "ﬀ" <= c <= "ﬆ"}
    keys = [*single, *gone]
    out = F.translate(col, "".join(keys), "".join(single[c] for c in single))
    for c, f in many.items():
        out = F.replace(out, F.lit(c), F.lit(f))
    return F.when(may_change(col), out).otherwise(col)
