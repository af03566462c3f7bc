"""Near-duplicate texts by a join on bits of parity sketches, exact for the stated similarity.

Two texts are alike if the words they share, counted with repetition, make up at least ``similarity`` of the words of the longer
one.  Each occurrence of a word (word and how often it came before) is XOR-hashed to one position of a sketch of 2**64 bits,
kept as the list of its set bits, and folded to a dense sketch of 128 bits.  Flipping one occurrence flips one bit, so the
Hamming distance of two sketches never exceeds the symmetric difference of the texts.

*Pigeonhole.*  Texts of n words that are alike differ in at most n - ceil(similarity * n) set bits on either side.  So among
the n - ceil(similarity * n) + k set bits that come first in a fixed order of all bits, they have at least k in common.  The
order is by rarity in the corpus.  Each text emits combinations of up to k of these bits, as short as they are rare enough in its
size band, and texts of a fitting band meet on equal combinations; so the number of meetings stays in proportion to the corpus
although its vocabulary does not grow.  (Two bits of one text that fall together are at odds of 1 in 2**50 or so and ignored.)

The holes are thus chosen bits and not fixed segments of the sketch.  Of 2 * (n - ceil(similarity * n)) + 1 fixed segments one
has to agree, which is as exact, but at a similarity of 0.8 a segment has two or three words, mostly frequent ones: measured on
126 000 captions, 28 segments a text would meet 475 000 others each, and if three segments have to agree there are 2 200
combinations a text, against 148 here.

*Rounds.*  As the vocabulary does not grow with the corpus, bits become frequent and combinations long and many: their number
grows faster than the corpus.  So that the disk does not, the search runs in as many rounds as keep what one of them shuffles in
proportion to the words (estimated from a sample of texts).  A round takes the combinations whose first bit falls to it, so every
combination is made in exactly one round; its pairs are written down and its shuffle files removed before the next begins.

*Verify.*  Meeting texts are compared by the dense sketches first, then, once for all rounds, by their full lists of set bits.

Texts with equal words in any order are one class: only one of them enters the join, the others follow by membership.

The rarity table has ``SLOTS`` counters whatever the corpus; it is the only thing that reaches the driver.
Null texts and texts of fewer than ``min_words`` words take no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figcurate.session import shared_checkpoint, spread

SLOTS = 1 << 17
DENSE = 128
#: Expected texts with a single bit, or with a combination, up to which it is emitted without another bit.
FEW_FIRST, FEW = 8.0, 2.0
#: Signatures keep 48 bits, which makes the rows shorter; chance meetings end at the first comparison.
SHORTEN = np.uint64(16)
#: Size bands end at ``BAND_START`` times a power of ``BAND_RATIO`` words.
BAND_START, BAND_RATIO, BANDS = 160, 4, 16
#: Words whose combinations are made at once.
WORDS_AT_ONCE = 1 << 20
#: Bytes a round may shuffle for each word of the corpus, and in any case.
ROUND_BYTES, ROUND_LEAST = 32, 1 << 26
#: Bytes shuffled for a combination and for two texts expected to meet.
SIGNATURE_BYTES, MEETING_BYTES = 14, 40
#: Texts from which the number of rounds is estimated.
SAMPLE = 10_000
_WORD = re.compile(r"[^\W_]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of a public 64-bit hash)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def occurrence_bits(texts: list[str], min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the texts with enough words: their numbers, their numbers of words, and the bits of all occurrences end to end."""
    import xxhash

    chosen, lengths, coded, table, seen = [], [], [], [], {}
    for i, text in enumerate(texts):
        words = _WORD.findall(text.lower())
        if len(words) < min_words:
            continue
        chosen.append(i)
        lengths.append(len(words))
        for word in words:
            k = seen.get(word)
            if k is None:
                k = seen[word] = len(table)
                table.append(xxhash.xxh64_intdigest(word.encode()))
            coded.append(k)
    n = np.array(lengths, dtype=np.int64)
    codes = np.array(coded, dtype=np.int64)
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((codes, doc))
    codes = codes[order]  # doc is sorted already
    fresh = np.ones(len(codes), dtype=bool)
    if len(codes):
        fresh[1:] = (codes[1:] != codes[:-1]) | (doc[1:] != doc[:-1])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(codes)), 0)) if len(codes) else codes
    before = (np.arange(len(codes)) - start).astype(np.uint64)
    with np.errstate(over="ignore"):
        bits = _mix(np.array(table, dtype=np.uint64)[codes] + before * _ODD) if len(codes) else np.zeros(0, dtype=np.uint64)
    return np.array(chosen, dtype=np.int64), n, bits


def sketches(texts: DataFrame, min_words: int) -> DataFrame:
    """(id, text) to (id, doc, check, n, bits): ``doc`` and ``check`` hash the whole multiset of words."""
    schema = "id bigint, doc bigint, check bigint, n int, bits array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column(1).cast(pa.string()).dictionary_encode()
            chosen, n, bits = occurrence_bits(coded.dictionary.to_pylist(), min_words)
            place = np.full(len(coded.dictionary) + 1, -1)
            place[chosen] = np.arange(len(chosen))
            index = np.asarray(coded.indices.fill_null(len(coded.dictionary))).astype(np.int64)
            rows = np.unique(np.stack([np.asarray(batch.column(0)), place[index]], axis=1)[place[index] >= 0], axis=0)
            ends = np.concatenate([[0], np.cumsum(n)])
            with np.errstate(over="ignore"):
                doc = np.add.reduceat(bits, ends[:-1]) if len(n) else np.zeros(0, dtype=np.uint64)
                check = np.bitwise_xor.reduceat(_mix(bits + _ODD), ends[:-1]) if len(n) else doc
            which = rows[:, 1]
            sizes = n[which]
            at = np.repeat(ends[which] - np.concatenate([[0], np.cumsum(sizes)])[:-1], sizes) + np.arange(sizes.sum())
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(bits[at].view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[:, 0]),
                    pa.array(doc.view(np.int64)[which]),
                    pa.array(check.view(np.int64)[which]),
                    pa.array(sizes.astype(np.int32)),
                    lists,
                ],
                names=["id", "doc", "check", "n", "bits"],
            )

    return spread(texts.select(F.col("id").cast("bigint"), "text")).mapInArrow(run, schema)


def bit_rarity(classes: DataFrame) -> np.ndarray:
    """How many texts set a bit of each of ``SLOTS`` slots, counted over all texts; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            bits = np.asarray(batch.column(0).flatten()).view(np.uint64)
            total += np.bincount((bits & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(total[slots])], names=["slot", "n"])

    rows = classes.select("bits").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    out = np.zeros(SLOTS, dtype=np.int64)
    pdf = rows.toPandas()
    out[pdf["slot"].to_numpy(dtype=np.int64)] = pdf["n"].to_numpy(dtype=np.int64)
    return out


def least_shared(n: np.ndarray, similarity: float) -> np.ndarray:
    """ceil(similarity * n) without rounding errors."""
    share = Fraction(similarity).limit_denominator(1000)
    return -(-(n * share.numerator) // share.denominator)


def size_bands(n: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size, and the highest band that holds sizes it can be alike to: its own or the next."""
    ends = BAND_START * BAND_RATIO ** np.arange(BANDS)
    share = Fraction(similarity).limit_denominator(1000)
    largest = n * share.denominator // share.numerator  # the longest text that can be alike
    return np.searchsorted(ends, n), np.searchsorted(ends, largest)


def band_sizes(classes: DataFrame, similarity: float) -> np.ndarray:
    """How many texts take part in each size band; one number a band reaches the driver."""
    ends = [BAND_START * BAND_RATIO**k for k in range(BANDS)]
    share = Fraction(similarity).limit_denominator(1000)

    def band(n: Column) -> Column:
        return sum((F.when(n > end, 1).otherwise(0) for end in ends), F.lit(0))

    n = F.col("n").cast("bigint")
    own, last = band(n), band(F.floor(n * share.denominator / share.numerator))
    rows = classes.select(F.explode(F.sequence(own, last)).alias("band")).groupBy("band").agg(F.count("*").alias("n")).collect()
    out = np.zeros(BANDS + 1)
    for row in rows:
        out[row.band] = row.n
    return out


def prefix_sizes(n: np.ndarray, similarity: float, depth: int) -> np.ndarray:
    """How many first bits of texts of n words take part."""
    return np.minimum(n - least_shared(n, similarity) + depth, n)


def rarest_first(lists: pa.ListArray, count_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bits of each list in their fixed order, end to end, and their counts."""
    bits = np.asarray(lists.flatten()).view(np.uint64)
    doc_no = np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists)))
    count = count_of[(bits & np.uint64(SLOTS - 1)).astype(np.int64)]
    order = np.lexsort((bits, count, doc_no))
    return bits[order], count[order]


def first_bits(classes: DataFrame, rarity: np.ndarray, similarity: float, depth: int) -> DataFrame:
    """(no, n, bits): of each text only the bits that ``signatures`` combines, so that a round reads no others."""
    shared = classes.sparkSession.sparkContext.broadcast(rarity.astype(np.float64))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, _ = rarest_first(batch.column(2), shared.value)
            sizes = np.asarray(batch.column(1)).astype(np.int64)
            kept = prefix_sizes(sizes, similarity, depth)
            ends = np.concatenate([[0], np.cumsum(kept)])
            at = np.repeat((np.cumsum(sizes) - sizes) - ends[:-1], kept) + np.arange(ends[-1])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(bits[at].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["no", "n", "bits"])

    return classes.select("no", "n", "bits").mapInArrow(run, "no bigint, n int, bits array<bigint>")


def signatures(
    classes: DataFrame,
    rarity: np.ndarray,
    n_classes: int,
    similarity: float,
    depth: int,
    in_band: np.ndarray,
    rounds: int = 1,
    turn: int = 0,
    counted: bool = False,
) -> DataFrame:
    """(no, n, signature): the pigeonholes in which texts meet, combinations of a text's first bits within a size band.

    A combination of bits, in their fixed order, is emitted as soon as few texts of the band are expected to have it, or when
    it has ``depth`` bits; otherwise it is extended by each later bit.  What is emitted depends on the rarity table and the
    numbers of texts by band alone, so two texts that share ``depth`` of their first bits share the combination that their
    first shared bits begin.  Long texts are fewer than short ones, so their bands are content with shorter combinations.
    A text whose alike ones may lie in the next band emits there too.  A bit that only one text sets leads to no meeting and
    is skipped.  ``bits`` may be all bits of a text or its ``first_bits``.

    Of several ``rounds``, round ``turn`` makes the combinations whose first bit falls to it.  ``counted`` gives instead
    (signatures, meetings), the numbers of combinations and of texts expected to have one of them as well.
    """
    schema = "signatures bigint, meetings double" if counted else "no bigint, n int, signature bigint"
    shared = classes.sparkSession.sparkContext.broadcast(rarity.astype(np.float64))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_of = shared.value
        for whole in batches:
            # long texts make many rows at once: a batch is cut where its words reach a bound
            words = np.cumsum(np.asarray(whole.column(1)).astype(np.int64))
            ends = np.flatnonzero(np.diff(words // WORDS_AT_ONCE, append=-1)) + 1
            for start, end in zip([0, *ends[:-1]], ends, strict=True):
                yield combine(whole.slice(int(start), int(end - start)), count_of)

    def combine(batch: pa.RecordBatch, count_of: np.ndarray) -> pa.RecordBatch:
        bits, count = rarest_first(batch.column(2), count_of)
        held = np.asarray(pc.list_value_length(batch.column(2))).astype(np.int64)
        starts = np.cumsum(held) - held
        sizes = np.asarray(batch.column(1)).astype(np.int64)
        prefix = prefix_sizes(sizes, similarity, depth)
        own, last = size_bands(sizes, similarity)
        meetings = 0.0
        out_doc: list[np.ndarray] = []
        out_sig: list[np.ndarray] = []

        def extend(docs: np.ndarray, at: int, level: int, code: np.ndarray, expected: np.ndarray) -> None:
            nonlocal meetings
            p = first.shape[1]
            for c in range(at, p):
                now = expected * counts[docs, c] / n_classes
                live = counts[docs, c] > 1
                if level == 1 and rounds > 1:
                    live &= first[docs, c] % np.uint64(rounds) == turn
                sig = _mix(code * _ODD + first[docs, c])
                enough = live & ((now <= (FEW_FIRST if level == 1 else FEW)) | (level == depth))
                if enough.any():
                    out_doc.append(names[docs[enough]])
                    out_sig.append(sig[enough])
                    meetings += now[enough].sum()
                more = live & ~enough
                if c + 1 < p and more.any():
                    extend(docs[more], c + 1, level + 1, sig[more], now[more])

        with np.errstate(over="ignore"):
            for band in range(int(own.min(initial=0)), int(last.max(initial=-1)) + 1):
                inside = (own <= band) & (band <= last)
                for p in np.unique(prefix[inside & (prefix > 0)]):
                    names = np.flatnonzero(inside & (prefix == p))
                    place = starts[names][:, None] + np.arange(p)
                    first, counts = bits[place], count[place]
                    code = np.full(len(names), band, dtype=np.uint64)
                    extend(np.arange(len(names)), 0, 1, code, np.full(len(names), in_band[band]))
        if counted:
            return pa.RecordBatch.from_arrays([pa.array([sum(map(len, out_sig))]), pa.array([float(meetings)])], names=["signatures", "meetings"])
        which = np.concatenate(out_doc) if out_doc else np.zeros(0, dtype=np.int64)
        sig = (np.concatenate(out_sig) >> SHORTEN).view(np.int64) if out_sig else np.zeros(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(which)), batch.column(1).take(pa.array(which)), pa.array(sig)], names=["no", "n", "signature"]
        )

    return classes.select("no", "n", "bits").mapInArrow(run, schema)


def rounds_needed(classes: DataFrame, rarity: np.ndarray, n_classes: int, similarity: float, depth: int, in_band: np.ndarray) -> int:
    """Rounds that keep what each of them shuffles in proportion to the corpus; two numbers reach the driver."""
    one_in = max(1, n_classes // SAMPLE)
    sample = classes.where(F.pmod("doc", F.lit(one_in)) == 0)
    load = signatures(sample, rarity, n_classes, similarity, depth, in_band, counted=True).agg(F.sum("signatures"), F.sum("meetings"))
    words = sample.agg(F.sum("n"))
    (made, met), (n_words,) = load.first(), words.first()
    if not n_words:
        return 1
    shuffled = made * SIGNATURE_BYTES + met / 2 * MEETING_BYTES
    return max(1, math.ceil(shuffled / max(n_words * ROUND_BYTES, ROUND_LEAST / one_in)))


def dense_sketches(classes: DataFrame) -> DataFrame:
    """``classes`` with the dense parity sketch as two 64-bit columns."""
    schema = "doc bigint, n int, bits array<bigint>, s0 bigint, s1 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            bits = np.asarray(lists.flatten()).view(np.uint64)
            cell = np.repeat(np.arange(len(sizes)), sizes) * DENSE + (bits >> np.uint64(57)).astype(np.int64)
            parity = (np.bincount(cell, minlength=len(sizes) * DENSE) & 1).astype(np.uint8).reshape(-1, DENSE)
            packed = np.packbits(parity, axis=1).view(np.int64).reshape(-1, DENSE // 64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), *(pa.array(np.ascontiguousarray(packed[:, k])) for k in range(2))],
                names=["doc", "n", "bits", "s0", "s1"],
            )

    return classes.select("doc", "n", "bits").mapInArrow(run, schema)


def near_duplicate_classes(
    texts: DataFrame, similarity: float = 0.8, min_words: int = 45, depth: int = 3
) -> tuple[DataFrame, DataFrame]:
    """From (id, text): members (id, doc) and links (doc_a, doc_b), doc_a < doc_b, between different classes."""
    depth = max(1, min(depth, int(least_shared(np.array([max(1, min_words)]), similarity)[0])))
    rows = shared_checkpoint(sketches(texts, max(1, min_words)))
    members = rows.select("id", "doc", "check").distinct()
    classes = rows.groupBy("doc", "check").agg(F.first("n").alias("n"), F.first("bits").alias("bits")).drop("check")
    # short running numbers stand for the texts in the join; they are written down with the texts, so they never change
    classes = shared_checkpoint(dense_sketches(classes).withColumn("no", F.monotonically_increasing_id()))
    n_classes = classes.count()
    rarity, in_band = bit_rarity(classes), band_sizes(classes, similarity)
    how = (rarity, max(1, n_classes), similarity, depth, in_band)
    rounds = rounds_needed(classes, *how)
    share = Fraction(similarity).limit_denominator(1000)

    # Spark cannot know how many rows the pigeonholes are or how long lists of bits, so the joins are told never to broadcast
    def side(x: str, *columns: str) -> DataFrame:
        return classes.select(*(F.col(c).alias(f"{c}_{x}") for c in ("no", *columns))).hint("merge")

    def close_pairs(texts: DataFrame, turn: int) -> DataFrame:
        holes = signatures(texts, *how, rounds, turn).hint("merge")
        a, b = holes.alias("a"), holes.alias("b")
        fits = F.least("a.n", "b.n") * share.denominator >= F.greatest("a.n", "b.n") * share.numerator
        meet = a.join(b, (F.col("a.signature") == F.col("b.signature")) & (F.col("a.no") < F.col("b.no")) & fits)
        candidates = meet.select(F.col("a.no").alias("no_a"), F.col("b.no").alias("no_b")).distinct()
        sketch = ("n", "s0", "s1")
        needed = F.ceil(F.greatest("n_a", "n_b") * share.numerator / share.denominator)
        distance = sum((F.bit_count(F.col(f"s{k}_a").bitwiseXOR(F.col(f"s{k}_b"))) for k in range(2)), F.lit(0))
        return (
            candidates.join(side("a", *sketch), "no_a")
            .join(side("b", *sketch), "no_b")
            .where(distance <= F.col("n_a") + F.col("n_b") - 2 * needed)
            .select("no_a", "no_b", needed.alias("needed"))
        )

    if rounds == 1:
        close = close_pairs(classes, 0)
    else:
        firsts = shared_checkpoint(first_bits(classes, rarity, similarity, depth))
        found = [shared_checkpoint(close_pairs(firsts, turn), release=True) for turn in range(rounds)]
        close = reduce(DataFrame.unionByName, found).distinct()  # a pair may meet in several rounds
    links = (
        close.join(side("a", "doc", "bits"), "no_a")
        .join(side("b", "doc", "bits"), "no_b")
        .where(F.size(F.array_intersect("bits_a", "bits_b")) >= F.col("needed"))
        .select(F.least("doc_a", "doc_b").alias("doc_a"), F.greatest("doc_a", "doc_b").alias("doc_b"))
    )
    return members.select("id", "doc"), links


def near_duplicate_pairs(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of ids with alike texts, including equal ones, each once."""
    a = members.select(F.col("id").alias("x"), F.col("doc").alias("doc_a")).hint("merge")
    b = members.select(F.col("id").alias("y"), F.col("doc").alias("doc_b")).hint("merge")
    across = links.join(a, "doc_a").join(b, "doc_b").select("x", "y")
    same = a.join(b, F.col("doc_a") == F.col("doc_b")).where(F.col("x") < F.col("y")).select("x", "y")
    both = across.unionByName(same).where(F.col("x") != F.col("y"))
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def duplicate_summary(members: DataFrame, links: DataFrame) -> DataFrame:
    """(id, class_id, class_size, n_links): one row per id and class; ``class_id`` is the smallest id of the class."""
    sizes = members.groupBy("doc").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    ends = links.select(F.explode(F.array("doc_a", "doc_b")).alias("doc")).groupBy("doc").agg(F.count("*").alias("n_links"))
    return (
        members.join(sizes.hint("merge"), "doc").join(ends.hint("merge"), "doc", "left")
        .select("id", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    )
