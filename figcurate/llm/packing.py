"""Filling containers of fixed capacity with documents that belong together.

*Sharded index.*  ``LEADERS`` documents (those with the smallest hash of their id, a bounded sample) make a small BM25 index that
every task holds.  Each document of the corpus asks it for its two nearest leaders; documents with the same answer make a cell.
Cells laid end to end are cut into shards of about ``SHARD`` documents, so near documents lie in the same shard wherever they come
from, a large cell is dealt to many shards, and every document is indexed: each shard holds the BM25 index of its documents over
all their terms.

*Packing.*  The largest unused document of a shard opens a container as its seed; the index ranks the unused documents by their
likeness to it, and they fill the container in this order as long as they fit.  What room is left goes to the largest unused
documents that still fit.  ``role`` tells how a document came in: seed, neighbour, rest or whole (a full piece of its own).

A document is split only if it alone exceeds the capacity: into full containers and one remainder, which is packed like any
other document.  Null and empty texts have no tokens; they lie in some container of their shard and take no room.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from copy import copy
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from figcurate.llm.tokens import DEFAULT_PATTERN, DEFAULT_VOCABULARY, FragmentEncoder
from figcurate.session import shared_checkpoint, spread

SHARD = 2048
#: Documents that make the index of cells, at least so many characters long.
LEADERS, LEADER_CHARS = 256, 200
#: BM25 constants (usual values).
K1, B = 1.2, 0.75
_TERM = re.compile(r"[^\W_]+")


class TermCounter:
    """Distinct terms of texts with their counts; each distinct token of a batch is analysed once."""

    def __init__(self, memory: int = 400_000):
        self.memory, self.seen = memory, {}

    def _term(self, token: str) -> int:
        found = self.seen.get(token)
        if found is None:
            import xxhash

            if len(self.seen) >= self.memory:
                self.seen.clear()
            terms = _TERM.findall(token.lower())
            found = self.seen[token] = xxhash.xxh32_intdigest(" ".join(terms).encode()) if terms else -1
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term, count), sorted by document."""
        split = pc.split_pattern_regex(pc.fill_null(texts.cast(pa.string()), ""), r"[ \n\t]+")
        coded = split.values.dictionary_encode()
        terms = np.array([self._term(t) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        term = terms[np.asarray(coded.indices)] if len(terms) else np.zeros(0, dtype=np.int64)
        doc = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)))
        known = term >= 0
        both, count = np.unique((doc[known] << 32) | term[known], return_counts=True)
        return both >> 32, both & 0xFFFFFFFF, count


class Leaders:
    """The BM25 index of the leaders, which is asked for the two nearest to each document."""

    def __init__(self, texts: list[str]):
        doc, term, count = TermCounter()(pa.array(texts, type=pa.string()))
        self.n = len(texts)
        index = Bm25(np.searchsorted(doc, np.arange(self.n + 1)), term, count.astype(np.float64))
        sizes = np.diff(index.starts)
        telling = sizes <= max(self.n // 4, 1)  # what a quarter of the leaders hold tells none of them apart
        kept = np.repeat(telling, sizes)
        self.terms, self.docs, self.weights = np.unique(term)[telling], index.docs[kept], index.weights[kept]
        self.starts = np.concatenate([[0], np.cumsum(sizes[telling])])

    def cells(self, n: int, doc: np.ndarray, term: np.ndarray) -> np.ndarray:
        """The cell of each of ``n`` documents; those that share no term with any leader are one cell."""
        out = np.full(n, self.n * self.n, dtype=np.int64)
        if not len(self.terms) or not len(doc):
            return out
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[at] == term
        doc, at = doc[known], at[known]
        for first in range(0, n, 512):  # scores of so many documents at a time
            low, high = np.searchsorted(doc, [first, first + 512])
            spans = self.starts[at[low:high] + 1] - self.starts[at[low:high]]
            place = np.repeat(self.starts[at[low:high]] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            row = np.repeat(doc[low:high] - first, spans)
            rows = min(512, n - first)
            score = np.bincount(row * self.n + self.docs[place], weights=self.weights[place], minlength=rows * self.n).reshape(rows, self.n)
            best = score.argmax(1)
            some = score[np.arange(rows), best] > 0
            score[np.arange(rows), best] = -1
            second = score.argmax(1) if self.n > 1 else best
            out[first : first + rows][some] = (best * self.n + second)[some]
        return out


def leader_texts(documents: DataFrame, leaders: int = LEADERS) -> list[str]:
    """The texts of at most ``leaders`` documents; a bounded sample."""
    few = documents.where(F.length("text") >= LEADER_CHARS).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(leaders)
    rows = documents.select("doc_id", "text").join(F.broadcast(few.distinct()), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "text").collect()
    return [r.text for r in rows][:leaders]


def measured(
    documents: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, pattern: str = DEFAULT_PATTERN, leaders: int = LEADERS
) -> DataFrame:
    """(doc_id, n_tokens, cell, terms, counts) of every document; one pass, no shuffle."""
    index = Leaders(leader_texts(documents, leaders))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, counter = FragmentEncoder(vocabulary, pattern), TermCounter()
        for batch in batches:
            n, _ = encoder.encode(batch.column(1), count_only=True)
            doc, term, count = counter(batch.column(1))
            offsets = pa.array(np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n.astype(np.int64)),
                    pa.array(index.cells(len(n), doc, term).astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.uint32).view(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(np.minimum(count, 32767).astype(np.int16))),
                ],
                names=["doc_id", "n_tokens", "cell", "terms", "counts"],
            )

    schema = "doc_id bigint, n_tokens bigint, cell int, terms array<int>, counts array<smallint>"
    return spread(documents.select(F.col("doc_id").cast("bigint"), "text")).mapInArrow(run, schema)


class Bm25:
    """An inverted index of one shard."""

    def __init__(self, offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        n = len(offsets) - 1
        self.n, self.offsets = n, offsets
        names, term = np.unique(terms, return_inverse=True)
        doc = np.repeat(np.arange(n), np.diff(offsets))
        df = np.bincount(term, minlength=len(names))
        length = np.bincount(doc, weights=counts, minlength=n)
        mean = max(length.mean() if n else 0.0, 1e-9)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * counts * (K1 + 1) / (counts + K1 * (1 - B + B * length[doc] / mean))
        weight[(df < 2)[term]] = 0.0  # no other document holds it
        order = np.argsort(term, kind="stable")
        self.starts = np.concatenate([[0], np.cumsum(df)])
        self.docs, self.weights = doc[order], weight[order]
        self.term, self.idf = term, np.where(df < 2, 0.0, idf)

    def among(self, wanted: np.ndarray) -> Bm25:
        """The index with the postings of the ``wanted`` documents only; weights stay as they are."""
        out, kept = copy(self), wanted[self.docs]
        out.docs, out.weights = self.docs[kept], self.weights[kept]
        out.starts = np.concatenate([[0], np.cumsum(kept)])[self.starts]
        return out

    def scores(self, doc: int) -> np.ndarray:
        """BM25 scores of all documents for the terms of ``doc``."""
        query = self.term[self.offsets[doc] : self.offsets[doc + 1]]
        query = query[self.idf[query] > 0]
        first, spans = self.starts[query], self.starts[query + 1] - self.starts[query]
        at = np.repeat(first - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
        return np.bincount(self.docs[at], weights=self.weights[at], minlength=self.n)


SEED, NEIGHBOUR, REST, WHOLE = range(4)
ROLES = ("seed", "neighbour", "rest", "whole")


def _ranked(score: np.ndarray, first: int = 32) -> Iterator[int]:
    """All items with a score, the highest first, ties in order; the first few are sorted before the others."""
    near = np.flatnonzero(score > 0)
    if len(near) > 2 * first:
        bound = np.partition(score[near], len(near) - first)[len(near) - first]
        parts = [near[score[near] >= bound], near[score[near] < bound]]
    else:
        parts = [near]
    for part in parts:
        yield from part[np.argsort(-score[part], kind="stable")].tolist()


def fill(sizes: np.ndarray, items: np.ndarray, capacity: int, index: Bm25) -> tuple[np.ndarray, np.ndarray]:
    """The container of every document of ``items`` (-1 for others) and how it came in; none is larger than the capacity."""
    n = len(sizes)
    container = np.full(n, -1, dtype=np.int64)
    role = np.full(n, REST, dtype=np.int8)
    unused = np.zeros(n, dtype=bool)
    unused[items] = True
    left = held = len(items)
    index = index.among(unused)
    by_size: dict[int, list[int]] = {}
    for i in np.sort(items)[::-1]:
        by_size.setdefault(int(sizes[i]), []).append(int(i))
    available = sorted(by_size)

    def take(i: int, size: int, number: int) -> None:
        by_size[size].remove(i)
        if not by_size[size]:
            del available[bisect_right(available, size) - 1]
        unused[i] = False
        container[i] = number
        nonlocal left
        left -= 1

    number = 0
    while available:
        size = available[-1]
        seed = by_size[size][-1]
        take(seed, size, number)
        role[seed] = SEED
        room = capacity - size
        if available and room >= available[0] and size > 0:
            if left < 0.5 * held:  # postings of used documents are left behind from time to time
                index, held = index.among(unused), left
            score = index.scores(seed)
            score[~(unused & (sizes <= room))] = 0.0
            for i in _ranked(score):
                if sizes[i] <= room:
                    take(i, int(sizes[i]), number)
                    role[i] = NEIGHBOUR
                    room -= int(sizes[i])
                    if not available or room < available[0]:
                        break
        while available and (at := bisect_right(available, room)):
            size = available[at - 1]
            take(by_size[size][-1], size, number)
            room -= size
        number += 1
    return container, role


def pack(items: DataFrame, specs: DataFrame, n_documents: int, shard: int = SHARD) -> DataFrame:
    """(spec_id, container_id, doc_id, piece, start_token, n_tokens, role); ``items`` come from ``measured``.

    ``specs`` is a fixed list of (spec_id, capacity_tokens); capacities below one are ignored.
    """
    wanted = [(int(r.spec_id), int(r.capacity_tokens)) for r in specs.orderBy("spec_id").collect() if (r.capacity_tokens or 0) > 0]
    shards = max(1, ceil(n_documents / shard))
    schema = "spec_id int, container_id string, doc_id bigint, piece int, start_token bigint, n_tokens bigint, role string"

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("doc_id")
        name = str(table["shard"][0].as_py())
        doc_id = table["doc_id"].combine_chunks()
        tokens = table["n_tokens"].to_numpy().astype(np.int64)
        lists = table["terms"].combine_chunks()
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        index = Bm25(offsets, lists.flatten().to_numpy(), table["counts"].combine_chunks().flatten().to_numpy().astype(np.float64))
        out = []
        for spec, capacity in wanted:
            whole = np.where(tokens > capacity, tokens // capacity, 0)
            rest = tokens - whole * capacity
            packed = (whole == 0) | (rest > 0)  # a document of exactly so many containers leaves nothing to pack
            which = np.flatnonzero(packed)
            container, role = fill(rest, which, capacity, index)
            first = int(container.max(initial=-1)) + 1
            full = np.repeat(np.arange(len(tokens)), whole)
            piece = np.arange(len(full)) - np.repeat(np.cumsum(whole) - whole, whole)
            rows = np.concatenate([which, full])
            number = np.concatenate([container[which], first + np.arange(len(full))])
            roles = np.concatenate([role[which], np.full(len(full), WHOLE, dtype=np.int8)])
            out.append(
                pa.table(
                    {
                        "spec_id": pa.array(np.full(len(rows), spec, dtype=np.int32)),
                        "container_id": pa.array([f"{name}-{k}" for k in number]),
                        "doc_id": doc_id.take(pa.array(rows)),
                        "piece": pa.array(np.concatenate([whole[which], piece]).astype(np.int32)),
                        "start_token": pa.array(np.concatenate([whole[which] * capacity, piece * capacity])),
                        "n_tokens": pa.array(np.concatenate([rest[which], np.full(len(full), capacity, dtype=np.int64)])),
                        "role": pa.DictionaryArray.from_arrays(pa.array(roles), pa.array(ROLES)).cast(pa.string()),
                    }
                )
            )
        return pa.concat_tables(out) if out else pa.table({f: [] for f in ("spec_id", "container_id", "doc_id", "piece", "start_token", "n_tokens", "role")})

    return with_shards(items, shards).groupBy("shard").applyInArrow(run, schema)


def with_shards(items: DataFrame, shards: int) -> DataFrame:
    """``items`` with ``shard``: cells laid end to end and cut into equal parts; a document's place in its cell is its hash.

    There are at most ``LEADERS``² + 1 cells, whatever the corpus.
    """
    items = shared_checkpoint(items)
    counts = items.groupBy("cell").agg(F.count("*").alias("in_cell"))
    whole = Window.partitionBy(F.lit(0))  # one row a cell
    running = F.sum("in_cell").over(whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cells = counts.select("cell", "in_cell", (running - F.col("in_cell")).alias("before"), F.sum("in_cell").over(whole).alias("total"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    at = (F.col("before") + place * F.col("in_cell")) / F.col("total")
    shard = F.least(F.floor(at * shards), F.lit(shards - 1)).cast("bigint")
    return items.join(F.broadcast(cells), "cell").withColumn("shard", shard).drop("in_cell", "before", "total", "cell")


def utilisation(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, capacity_tokens, n_containers, n_tokens, fill, with_neighbour) of a packing.

    ``with_neighbour`` is the share of tokens in a container to which retrieval brought at least one document.
    """
    near = F.bool_or(F.col("role") == ROLES[NEIGHBOUR])
    per_container = packed.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("n"), near.alias("near"))
    totals = per_container.groupBy("spec_id").agg(
        F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"), F.sum(F.when(F.col("near"), F.col("n")).otherwise(0)).alias("near")
    )
    capacity = F.col("capacity_tokens").cast("bigint")
    return totals.join(F.broadcast(specs.select("spec_id", capacity.alias("capacity_tokens"))), "spec_id").select(
        "spec_id", "capacity_tokens", "n_containers", "n_tokens",
        F.round(F.try_divide(F.col("n_tokens"), F.col("n_containers") * F.col("capacity_tokens")), 6).alias("fill"),
        F.round(F.try_divide("near", "n_tokens"), 6).alias("with_neighbour"),
    )


def packing_faults(packed: DataFrame, specs: DataFrame, documents: DataFrame) -> DataFrame:
    """(spec_id, capacity_tokens, documents, missing, overfull, split_though_fitting, gaps): what a packing must keep, by spec.

    ``missing`` documents are in no container, ``overfull`` containers hold more than fits, ``split_though_fitting`` documents were cut
    though they fit, ``gaps`` are tokens lost or repeated between the pieces of a document.
    """
    capacity = F.broadcast(specs.select("spec_id", F.col("capacity_tokens").cast("bigint").alias("capacity_tokens")))
    by_doc = packed.groupBy("spec_id", "doc_id").agg(
        F.count("*").alias("pieces"), F.sum("n_tokens").alias("n"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end")
    )
    over = packed.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("n")).join(capacity, "spec_id")
    overfull = over.groupBy("spec_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("overfull"))
    counted = by_doc.join(capacity, "spec_id").groupBy("spec_id", "capacity_tokens").agg(
        F.count("*").alias("packed"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("split_though_fitting"),
        F.sum(F.abs(F.col("n") - F.col("end"))).alias("gaps"),
    )
    total = documents.select(F.countDistinct("doc_id")).scalar()
    return counted.join(F.broadcast(overfull), "spec_id").withColumn("documents", total).select(
        "spec_id", "capacity_tokens", "documents", (F.col("documents") - F.col("packed")).alias("missing"), "overfull", "split_though_fitting", "gaps"
    )
