"""Token ids of whole texts by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged over, so a cut between its two bytes is certain.  The
full table of such pairs is read from the vocabulary (``pairs_inside``), and every text is cut at all of them where the
pre-tokenizer ends no piece differently for it (``certain_cuts``); each distinct fragment is encoded once, and the ids of the
fragments are laid end to end.

For vocabularies whose tokens hold white space only at their start, every space after another character is such a cut; there
texts are first split at spaces as whole columns, and the fragments then at the other pairs.  Other vocabularies take all cuts
from the table.

Null and empty texts have the empty list of ids.  Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figcurate.session import spread

#: Where the vocabulary lies; a parameter of every operator, the setting of the process is its default.
DEFAULT_VOCABULARY = os.environ.get("TOKENIZER_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: The pre-tokenizer pattern that belongs to the byte-level vocabularies (fixed value).
DEFAULT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fragments remembered between batches; beyond it the memory is emptied, which costs time but changes nothing.
MEMORY = 400_000
#: Characters up to which a fragment is encoded in one go, as looking for further cuts would take longer; the ids are the same.
SHORT = 24
#: White space before a space: the text is then cut by the slower general rule.
_RUN = r"[\t\n\x0b\f\r\x{85}\p{Z}] "


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def pairs_inside(ranks: dict[bytes, int]) -> np.ndarray:
    """Which byte pairs occur inside a token, as a table of 256 x 256."""
    out = np.zeros((256, 256), dtype=bool)
    for token in ranks:
        if len(token) > 1:
            b = np.frombuffer(token, dtype=np.uint8)
            out[b[:-1], b[1:]] = True
    return out


def cuts_before_space(ranks: dict[bytes, int]) -> bool:
    """Whether no token holds a space after a character other than white space, so that a cut before white space is certain."""
    for token in ranks:
        at = token.find(b" ", 1)
        while at > 0:
            before = token[:at].decode("utf-8", errors="replace")
            if not before[-1].isspace():
                return False
            at = token.find(b" ", at + 1)
    return True


def certain_cuts(text: str, inside: np.ndarray) -> list[str]:
    """``text`` cut between characters whose bytes meet inside no token.

    The pre-tokenizer must end its pieces alike with and without the cut.  Its runs of letters, digits or other characters end
    where they would anyway; white space followed by other characters is left together, as a run of white space gives up its
    last character to what follows; and so is an apostrophe with its neighbours, as it begins contractions.
    """
    data = text.encode()
    b = np.frombuffer(data, dtype=np.uint8)
    if len(b) < 2:
        return [text] if text else []
    at = np.flatnonzero(~inside[b[:-1], b[1:]] & ((b[1:] & 0xC0) != 0x80)) + 1
    if not len(at):
        return [text]
    out, start = [], 0
    for k in at.tolist():
        before = data[max(start, k - 4) : k].decode(errors="ignore")[-1:]
        after = data[k : k + 4].decode(errors="ignore")[:1]
        if "'" in (before, after) or (before.isspace() and not after.isspace()):
            continue
        out.append(data[start:k].decode())
        start = k
    out.append(data[start:].decode())
    return out


class FragmentEncoder:
    """Encodes Arrow string arrays; holds the ids of fragments already seen."""

    def __init__(self, path: str = DEFAULT_VOCABULARY, pattern: str = DEFAULT_PATTERN):
        import regex
        import tiktoken

        ranks = read_ranks(path)
        self._encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._inside = pairs_inside(ranks)
        self._certain = cuts_before_space(ranks)
        self._fragments = regex.compile(r"\p{White_Space}*[^\p{White_Space}]+|\p{White_Space}+").findall
        self._seen: dict[str, np.ndarray] = {}

    def _ids(self, fragment: str) -> np.ndarray:
        found = self._seen.get(fragment)
        if found is None:
            if len(self._seen) >= MEMORY:
                self._seen.clear()
            if len(fragment) > SHORT:
                ids = [i for piece in certain_cuts(fragment, self._inside) for i in self._encode(piece)]
            else:
                ids = self._encode(fragment)
            found = self._seen[fragment] = np.array(ids, dtype=np.int32)
        return found

    def _plan(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """For non-null texts: each text's number of fragments, the fragments' numbers, and the ids of each number."""
        if not self._certain:
            cut = [certain_cuts(t, self._inside) for t in texts.to_pylist()]
            coded = pa.array([f for fragments in cut for f in fragments], type=pa.string()).dictionary_encode()
            known = [np.array(self._encode(f), dtype=np.int32) for f in coded.dictionary.to_pylist()]
            return np.array([len(c) for c in cut], dtype=np.int64), np.asarray(coded.indices).astype(np.int64), known
        split = pc.split_pattern(texts, " ")
        parts, offsets = split.values, np.asarray(split.offsets)
        coded = parts.dictionary_encode()
        numbers = np.asarray(coded.indices).astype(np.int64)
        spaced = [self._ids(" " + part) for part in coded.dictionary.to_pylist()]
        # the first part of a text has no space before it
        starts = offsets[:-1]
        first = parts.take(pa.array(starts)).dictionary_encode()
        numbers = numbers.copy()
        numbers[starts] = np.asarray(first.indices) + len(spaced)
        return np.diff(offsets), numbers, spaced + [self._ids(part) for part in first.dictionary.to_pylist()]

    def encode(self, texts: pa.Array, count_only: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The number of ids of each text and, unless ``count_only``, all ids laid end to end."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        slow = np.asarray(pc.match_substring_regex(texts, _RUN)) if self._certain else np.zeros(len(texts), dtype=bool)
        fast_texts = texts if not slow.any() else pc.if_else(pa.array(slow), "", texts)
        per_text, numbers, ids = self._plan(fast_texts)
        length = np.array([len(x) for x in ids], dtype=np.int64)
        sizes = length[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        text_ends = np.concatenate([[0], np.cumsum(per_text)])
        counts = np.diff(ends[text_ends])
        general: dict[int, np.ndarray] = {}
        for i in np.flatnonzero(slow):
            pieces = [self._ids(f) for f in self._fragments(texts[int(i)].as_py())]
            general[int(i)] = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.int32)
            counts[i] = len(general[int(i)])
        if count_only:
            return counts, None
        flat = np.concatenate([*ids, np.zeros(0, dtype=np.int32)]).astype(np.int32)
        begin = np.concatenate([[0], np.cumsum(length)])[:-1]
        values = flat[np.repeat(begin[numbers] - ends[:-1], sizes) + np.arange(ends[-1])]
        if general:
            cut = np.split(values, ends[text_ends][1:-1])
            for i, found in general.items():
                cut[i] = found
            values = np.concatenate(cut)
        return counts, values


def encode_corpus(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY,
    pattern: str = DEFAULT_PATTERN,
) -> DataFrame:
    """(id, ids array<int>) of every row; no shuffle, one pass over the two columns read."""
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = FragmentEncoder(vocabulary, pattern)
        for batch in batches:
            counts, values = encoder.encode(batch.column(1))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=[id_col, "ids"])

    return spread(df.select(F.col(id_col), F.col(text_col))).mapInArrow(run, schema)
