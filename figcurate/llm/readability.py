"""Reading level of documents: classic readability formulas, combined by their median.

Every document gets five grade estimates from its sentences, words and syllables (counted with hyphenation-style rules):
Flesch–Kincaid, Gunning fog, SMOG, FORCAST and Powers–Sumner–Kearl.  Each is put on the raters' scale by interpolation between
its medians at the rated grades, and the level is the plain median of the five.

Two rules keep the formulas from being fooled.  Abbreviations and names made of capitals or digits are read letter by letter,
as they are spoken (``FACS`` and ``IC50`` have four syllables each), so that jargon of short signs is not taken for easy words.
The mean length of sentences is taken within ``SENTENCE_WORDS``, as lengths beyond tell of missing or stray full stops.

Fitting reads at most ``MAX_RATED`` rated documents (those with the smallest hash of their id).  Scoring reads every text in
whole: a batch is split at spaces, each distinct token is analysed once, and documents are sums over their tokens.

Null, empty and blank texts have no words and the level null.  Several ratings of one document count as their median; ratings
of unknown documents are ignored; without any ratings the formulas are taken as school grades, three to a level.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figcurate.session import spread

#: Bound on the rated documents used to fit.
MAX_RATED = 1000
#: Mean words of a sentence that the formulas are given at least and at most.
SENTENCE_WORDS = (8.0, 25.0)
CLASSIC = ("flesch_kincaid", "gunning_fog", "smog", "forcast", "powers_sumner_kearl")
#: Least share of English function words among the words of an English text.
ENGLISH_SHARE = 0.05

#: Frequent function words by language (fixed values); a word of several languages counts for each.
FUNCTION_WORDS = {
    "en": "the of and to in is was were that for with by from are this it on at be as which who not they has have had your we",
    "fr": "le la les des du une et est dans pour que qui sur avec pas par au cette sont ont plus",
    "de": "der die das und ist nicht mit von den dem des ein eine zu im am auf wurde sich in was",
    "es": "el los las del y es una en por con para que se su al como más fue la de",
    "nl": "de het een van en is in was niet met voor op aan dat bij zijn door naar te om uit ook worden wordt",
    "it": "il lo la gli di che e è del della nel un una con per non sono dei alla si al da in i le",
    "pt": "o os da do das dos e em um uma não com por para que se foi são ao na no de",
    "sv": "och att det som en på är av för med den till inte om var ett han de har vid i",
}
_LANGUAGES: dict[str, list[int]] = {}
for _k, _names in enumerate(FUNCTION_WORDS.values()):
    for _name in _names.split():
        _LANGUAGES.setdefault(_name, []).append(_k)

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_SPOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
_END = re.compile(r"[.!?]+[\"')\]”’]*(?=\s|$)")
_GROUP = re.compile(r"[aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüœ]+")


def syllables(word: str) -> int:
    """Vowel groups, less a silent final e (also in -es, -ed), plus a hiatus; one at least.

    A hiatus is -ia-, -io- outside -tion and -sion, -ua- outside -qua- and -gua-, and a final -ea after another vowel group.
    """
    total = 0
    for part in re.split(r"['’-]", word.lower()):
        n = len(_GROUP.findall(part))
        if n > 1:
            if re.search(r"[^aeiouyl]e$|[^aeiouy]le?s$" if not part.endswith("les") else r"$^", part):
                n -= 1
            elif re.search(r"[^aeiouytd]ed$|[^aeiouysxzcg]es$", part):
                n -= 1
            elif part.endswith(("ea", "eas")):
                n += 1
        n += len(re.findall(r"(?<![tscgx])i(?:a|o|u)(?!u)|(?<![qg])ua", part))
        total += max(n, 1) if part else 0
    return max(total, 1)


def spoken_syllables(word: str) -> int:
    """As ``syllables``; parts with digits, with capitals after the first letter or without a vowel are read letter by letter."""
    total = 0
    for part in re.split(r"['’-]", word):
        spelled = any(c.isdigit() for c in part) or part[1:] != part[1:].lower() or not _GROUP.search(part.lower())
        total += len(part) if spelled else syllables(part)
    return max(total, 1)


# columns of a token's analysis: ``WORDS`` are made of letters, ``SPOKEN`` also of digits if they hold a letter
WORDS, SPOKEN, SYLLABLES, SINGLE, POLY, ENDS, LATIN, OTHER = range(8)
TALLY = 8
WIDTH = TALLY + len(FUNCTION_WORDS)


@dataclass
class Model:
    """Calibration points; plain data, shipped with the closure."""

    points: dict[str, tuple[list[float], list[float]]] = field(default_factory=dict)


def analyse(token: str) -> np.ndarray:
    """The tallies of one token, which may hold several words if it has other white space than the space."""
    out = np.zeros(WIDTH)
    for m in _WORD.finditer(token):
        word = m.group()
        out[WORDS] += 1
        out[LATIN if word[0] < "ɐ" else OTHER] += len(word)
        for k in _LANGUAGES.get(word.lower(), ()):
            out[TALLY + k] += 1
    for m in _SPOKEN.finditer(token):
        word = m.group()
        if not word.isdigit():
            n = spoken_syllables(word)
            out[SPOKEN] += 1
            out[SYLLABLES] += n
            out[SINGLE] += n == 1
            out[POLY] += n >= 3
    out[ENDS] = len(_END.findall(token))
    return out


class Analyser:
    """Tallies of Arrow string arrays; remembers the tokens it has seen."""

    def __init__(self, memory: int = 400_000):
        self.memory, self.seen = memory, {}

    def __call__(self, texts: pa.Array) -> np.ndarray:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        split = pc.split_pattern(texts, " ")
        coded = split.values.dictionary_encode()
        rows = []
        for token in coded.dictionary.to_pylist():
            if token not in self.seen:
                if len(self.seen) >= self.memory:
                    self.seen.clear()
                self.seen[token] = analyse(token)
            rows.append(self.seen[token])
        table = np.array(rows).reshape(-1, WIDTH)
        numbers = np.asarray(coded.indices).astype(np.int64)
        doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)))
        out = np.empty((len(texts), WIDTH))
        for k in range(WIDTH):
            out[:, k] = np.bincount(doc, weights=table[numbers, k], minlength=len(texts)) if len(doc) else 0
        return out


def raw_estimates(tally: np.ndarray) -> dict[str, np.ndarray]:
    """The estimates of documents with at least one word, before calibration (constants as published)."""
    words = np.maximum(tally[:, SPOKEN], 1)
    length = np.clip(words / np.maximum(tally[:, ENDS], 1), *SENTENCE_WORDS)
    per_word, poly = tally[:, SYLLABLES] / words, tally[:, POLY] / words
    return {
        "flesch_kincaid": 0.39 * length + 11.8 * per_word - 15.59,
        "gunning_fog": 0.4 * (length + 100 * poly),
        "smog": 1.0430 * np.sqrt(30 * poly * length) + 3.1291,
        "forcast": 20 - 15 * tally[:, SINGLE] / words,
        "powers_sumner_kearl": 0.0778 * length + 4.55 * per_word - 2.2029,
    }


def fit(texts: list[str], levels: list[float]) -> Model:
    """The median of each estimate at each rated grade; estimates that do not tell the grades apart get no points."""
    model = Model()
    if not texts:
        return model
    steps = np.round(np.array(levels, dtype=float))
    tally = Analyser()(pa.array(texts, type=pa.string()))
    known = tally[:, WORDS] > 0
    for name, value in raw_estimates(tally).items():
        points = [(float(np.median(value[known & (steps == g)])), float(g)) for g in np.unique(steps[known])]
        xs = np.maximum.accumulate([x for x, _ in points]) if points else np.zeros(0)
        if len(points) >= 2 and xs[0] != xs[-1]:
            model.points[name] = ([float(x) for x in xs], [g for _, g in points])
    return model


def on_scale(values: np.ndarray, xs: list[float], ys: list[float]) -> np.ndarray:
    """Interpolation between the points; beyond them on with their mean slope, so grades that nobody rated can be reached."""
    slope = (ys[-1] - ys[0]) / (xs[-1] - xs[0])
    inside = np.interp(values, xs, ys)
    return np.clip(inside + slope * (np.minimum(values - xs[0], 0) + np.maximum(values - xs[-1], 0)), 1, 5)


def calibrated(model: Model, tally: np.ndarray) -> np.ndarray:
    """Calibrated estimates by document; without a fit, three school grades make a level."""
    raw = raw_estimates(tally)
    if not model.points:
        return np.stack([np.clip(raw[n] / 3, 1, 5) for n in CLASSIC], axis=1)
    return np.stack([on_scale(raw[n], *model.points[n]) for n in CLASSIC if n in model.points], axis=1)


def rated_sample(documents: DataFrame, labels: DataFrame, bound: int = MAX_RATED) -> tuple[list[str], list[float]]:
    """Texts and median ratings of at most ``bound`` rated documents, those whose ids have the smallest hashes."""
    rated = (
        labels.where(F.col("grade_level").isNotNull())
        .groupBy("doc_id")
        .agg(F.expr("percentile(grade_level, 0.5)").alias("level"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    rows = (
        documents.select("doc_id", "text").join(F.broadcast(rated), "doc_id").where(F.col("text").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    )
    return [r.text for r in rows], [float(r.level) for r in rows]


def reading_levels(documents: DataFrame, labels: DataFrame, bound: int = MAX_RATED) -> DataFrame:
    """(doc_id, n_words, is_english, grade double, level int) of every document.

    A text is English if English function words are at least ``ENGLISH_SHARE`` of its words and more than those of any other
    language known here, and it is mostly in the Latin script; if it has none of any, the ``lang`` column decides.
    """
    model = fit(*rated_sample(documents, labels, bound))
    schema = "doc_id bigint, n_words bigint, is_english boolean, grade double, level int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        analyser = Analyser()
        for batch in batches:
            tally = analyser(batch.column(1))
            grade = np.where(tally[:, WORDS] > 0, np.median(calibrated(model, tally), axis=1), np.nan)
            by_language = tally[:, TALLY:]
            said = np.array([str(x or "").strip().lower()[:2] == "en" for x in batch.column(2).to_pylist()], dtype=bool)
            most = (by_language[:, 0] > by_language[:, 1:].max(1)) & (by_language[:, 0] >= ENGLISH_SHARE * tally[:, WORDS])
            english = np.where(by_language.sum(1) > 0, most, said)
            english &= (tally[:, WORDS] > 0) & (tally[:, LATIN] >= tally[:, OTHER])
            unknown = np.isnan(grade)
            level = np.clip(np.floor(np.where(unknown, 0, grade) + 0.5), 1, 5).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(tally[:, WORDS].astype(np.int64)),
                    pa.array(english),
                    pa.array(np.where(unknown, 0.0, grade), mask=unknown),
                    pa.array(level, mask=unknown),
                ],
                names=["doc_id", "n_words", "is_english", "grade", "level"],
            )

    return spread(documents.select(F.col("doc_id").cast("bigint"), "text", "lang")).mapInArrow(run, schema)


def demanding_english(levels: DataFrame, min_words: int = 40, min_level: int = 4) -> DataFrame:
    return levels.where(F.col("is_english") & (F.col("n_words") >= min_words) & (F.col("level") >= min_level)).select("doc_id")
