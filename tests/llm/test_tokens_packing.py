import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from figcurate.llm import packing, tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.DEFAULT_VOCABULARY), reason="no vocabulary files")


@pytest.fixture(scope="module")
def whole():
    import tiktoken

    ranks = tokens.read_ranks(tokens.DEFAULT_VOCABULARY)
    return tiktoken.Encoding("own", pat_str=tokens.DEFAULT_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids_of(texts):
    counts, values = tokens.FragmentEncoder().encode(pa.array(texts, type=pa.string()))
    ends = np.concatenate([[0], np.cumsum(counts)])
    return [values[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


CASES = [
    "", None, " ", "  ", "a", "a  b", " lead", "trail ", "a \n b\n\nc  ", "x　 y", "don't  stop\t tab", "<|endoftext|> hi",
    "naïve ﬁ 東京 клиника", "\x1c \x1f a", "a\u0085 b", "word " * 3000, "x" * 20000, "é" * 50, "1,234.5 % of 'em'", "\r\n \r\n",
]


def test_ids_are_those_of_the_whole_text(whole):
    assert ids_of(CASES) == [whole(t or "") for t in CASES]
    assert ids_of([]) == []


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab1 .'\n\té　\u0085東", max_size=30), min_size=1, max_size=20))
def test_any_text(texts, whole):
    assert ids_of(texts) == [whole(t) for t in texts]


def test_the_cut_comes_from_the_vocabulary():
    ranks = tokens.read_ranks(tokens.DEFAULT_VOCABULARY)
    assert tokens.cuts_before_space(ranks)
    assert not tokens.cuts_before_space({**ranks, b"a b": 99999})


@pytest.mark.parametrize("extra", [{}, {b"a b": 99999}])
def test_cuts_at_all_impossible_pairs(whole, extra):
    ranks = tokens.read_ranks(tokens.DEFAULT_VOCABULARY)
    inside = tokens.pairs_inside({**ranks, **extra})
    r = np.random.default_rng(4)
    signs = list("ab'sre \n\t \u3000é中文漢字かな😀-_/.,:;0123()\"!?ÿ\x01€Ωж\u200b")
    texts = ["".join(r.choice(signs, size=int(n))) for n in r.integers(1, 40, 4000)] + ["漢字かな交じり文" * 2000, "https://a.b/c_d?e=f&g" * 500]
    cut = [tokens.certain_cuts(t, inside) for t in texts]
    assert ["".join(c) for c in cut] == texts and sum(map(len, cut)) > 20000
    if not extra:
        assert [[i for f in c for i in whole(f)] for c in cut] == [whole(t) for t in texts]
        assert max(map(len, cut[-2])) < 20  # text without spaces is cut too


def test_a_vocabulary_with_spaces_inside_takes_its_cuts_from_the_table(tmp_path):
    import base64

    import tiktoken

    ranks = tokens.read_ranks(tokens.DEFAULT_VOCABULARY)
    ranks[b"of the"] = max(ranks.values()) + 1
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % k for t, k in ranks.items()))
    encoder = tokens.FragmentEncoder(str(path), pattern=r"[^.]+|\.")
    whole = tiktoken.Encoding("x", pat_str=r"[^.]+|\.", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    texts = ["end of the line. 東京 and of the", "", "of thewords of  the"]
    counts, values = encoder.encode(pa.array(texts))
    assert values.tolist() == [i for t in texts for i in whole(t)] and counts.tolist() == [len(whole(t)) for t in texts]


def test_corpus(spark, whole):
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(CASES)], "doc_id bigint, text string, ids int")
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(rows).collect()}
    assert got == {i: whole(t or "") for i, t in enumerate(CASES)}
    assert tokens.encode_corpus(rows.limit(0)).count() == 0


def packed(spark, texts, specs=((1, 16), (2, 64)), shard=2048):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], "doc_id bigint, text string, shard string, n_tokens int")
    table = spark.createDataFrame(list(specs), "spec_id int, capacity_tokens int")
    return packing.pack(packing.measured(docs), table, len(texts), shard), table


def test_packing_keeps_every_token_once(spark, whole):
    r = np.random.default_rng(3)
    words = [f"term{k}" for k in range(40)]
    texts = [" ".join(r.choice(words, size=int(n))) for n in r.integers(1, 40, 150)] + ["", None, "the same text"] + ["the same text"] * 4
    out, specs = packed(spark, texts, shard=40)
    sizes = {i: len(whole(t or "")) for i, t in enumerate(texts)}
    rows = out.collect()
    for spec, capacity in ((1, 16), (2, 64)):
        mine = [x for x in rows if x.spec_id == spec]
        load = {}
        for x in mine:
            load[x.container_id] = load.get(x.container_id, 0) + x.n_tokens
        assert max(load.values()) <= capacity
        for i, n in sizes.items():
            pieces = sorted((x.start_token, x.n_tokens) for x in mine if x.doc_id == i)
            assert len(pieces) == (1 if n <= capacity else -(-n // capacity))  # split only if larger
            assert sum(b for _, b in pieces) == n and [a for a, _ in pieces] == [sum(b for _, b in pieces[:k]) for k in range(len(pieces))]
    fill = {x.spec_id: x.fill for x in packing.utilisation(out, specs).collect()}
    assert fill[1] > 0.85 and fill[2] > 0.85


def test_neighbours_share_a_container(spark):
    a = ["alpha beta gamma delta " * 2] * 4
    b = ["omega sigma kappa lambda " * 2] * 4
    texts = [x for pair in zip(a, b, strict=True) for x in pair]
    out, _ = packed(spark, texts, specs=((1, 60),))
    groups = {}
    for x in out.collect():
        groups.setdefault(x.container_id, set()).add(x.doc_id % 2)
    assert all(len(g) == 1 for g in groups.values())


def test_exact_multiples_and_empty_tables(spark):
    out, _ = packed(spark, [" a" * 32, " a" * 33, ""], specs=((1, 16), (9, 0)))
    got = sorted((x.doc_id, x.piece, x.n_tokens) for x in out.collect())
    assert got == [(0, 0, 16), (0, 1, 16), (1, 0, 16), (1, 1, 16), (1, 2, 1), (2, 0, 0)]
    assert packed(spark, ["x"])[0].limit(0).count() == 0
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(packing.measured(docs), spark.createDataFrame([(1, 8)], "spec_id int, capacity_tokens int"), 0).count() == 0


def test_bm25_prefers_rare_shared_terms():
    terms = np.array([1, 2, 1, 3, 1, 2, 9])
    index = packing.Bm25(np.array([0, 2, 4, 7]), terms, np.ones(7))
    score = index.scores(0)
    assert score[2] > score[1]
