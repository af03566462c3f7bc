import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from figcurate.llm import characters as C
from figcurate.llm import markup as M

CHANGED = {
    "Ｆｉｇｕｒｅ": "Figure", "𝐂𝐞𝐥𝐥": "Cell", "eﬀusion": "effusion", "5 µm": "5 μm", "Señara": "Señara", "a b": "a b", "co­op": "coop",
    "x​y": "xy", "phase‑contrast": "phase-contrast", "grоuр": "group", "νamimotin": "vamimotin", "ВYNZ19": "BYNZ19", "﻿Green": "Green",
    "dɑrk": "dark", "（n>１３）": "(n>13)", "ϲurve": "curve", "\u202afrom\u202c": "from",
    chr(0x2126): chr(0x3A9), "e\u0323\u0302": chr(0x1EC7), "o\u0302\u0323": chr(0x1ED9), chr(0x212A): "K",
    "a\u2003b": "a b", "ＡΒс": "ABc", "\u200d": "",
}
KEPT = [
    "3 × 10⁵ cm²", "x̄ = 4", "κ-VGKW3", "5 μm", "клиника", "εικόνα", "患者", "a – b — c", "Señara", "naïve Øre", "TNFα", "ß", "½ … ™ ①", "plain", "", "Δt",
]


def items(spark, texts):
    return spark.createDataFrame([(i, "caption", 0, t) for i, t in enumerate(texts)], "record_id bigint, text_field string, item int, text string")


def test_consistent_form(spark):
    texts = [*CHANGED, *KEPT, None]
    got = {r.record_id: (r.text, r.changed) for r in C.normalised(items(spark, texts)).collect()}
    assert {t: got[i] for i, t in enumerate(texts)} == {**{k: (v, True) for k, v in CHANGED.items()}, **{k: (k, False) for k in KEPT}, None: (None, False)}
    assert sorted(r.record_id for r in C.disguised(items(spark, texts)).collect()) == list(range(len(CHANGED)))


def test_repeated_words_and_arrays(spark):
    rows = spark.createDataFrame(
        [(1, ["ok", "grоuр a grоuр"], "x"), (2, None, "x"), (3, [], None), (4, [None, ""], ""), (5, ["grоuр"], "grоuр")],
        "record_id bigint, reference_texts array<string>, caption string",
    )
    both = C.text_items(rows, {"caption": False, "reference_texts": True})
    found = sorted((r.record_id, r.text_field) for r in C.disguised(both).collect())
    assert found == [(1, "reference_texts"), (5, "caption"), (5, "reference_texts")]
    fixed = [r.text for r in C.normalised(both).collect() if r.record_id == 1 and r.item == 1]
    assert fixed == ["group a group"]
    assert C.disguised(both.limit(0)).count() == 0 and C.normalised(both.limit(0)).count() == 0


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="aȩ̣́̂cñé 가x", min_size=1, max_size=8), min_size=30, max_size=30))
def test_composition_is_canonical(spark, texts):
    got = {r.record_id: r.text for r in C.normalised(items(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [unicodedata.normalize("NFC", t) for t in texts]


def test_a_second_pass_changes_nothing(spark):
    once = C.normalised(items(spark, list(CHANGED))).drop("changed")
    assert C.disguised(once).count() == 0


MARKED = [
    ("<b>bold</b> text here", "bold text here"), ("a&nbsp;b", "a\xa0b"), ("5 &lt; 6", "5 < 6"), ("**bold** words", "bold words"),
    ("see [the figure](f/x.png) now", "see the figure now"), ("''it'' was", "it was"), ("[[target|shown]] here", "shown here"),
    ("{{cite journal |title=x}} end.", "end."), ("\\textbf{strong} word", "strong word"), ("20\\% of mice", "20% of mice"),
    ("a <!-- query 3 --> b", "a b"), ("&lt;i&gt;in vivo&lt;/i&gt; data", "in vivo data"), ("~~gone~~ words", "gone words"),
]
UNMARKED = [
    "Data are means ± SD of 6 wells; *P < 0.05, **P < 0.01.", "The treated group (n>12) differed (n<40).", "values where a<9 and b>3 were dropped.",
    "Sections stained with H&E and AT&T", "Samples tbl_4_b and OD_600 readings", "which cost $48 to $132 per session", "earlier work [12, 30]", "", None,
    "Scale bar, 20 μm.", "*P < 0.05; ***P < 0.001 by controls.",
]


@pytest.fixture(scope="module")
def field():
    return M.default_field()


def test_labels_of_unseen_pages(field):
    right = total = 0
    for page in M.labelled_pages(300, seed=123):
        text, truth = M.label_leaves(page)
        guess = field.decode([M.chain(text)[1]])[0]
        right += sum(int(a == b) for a, b in zip(truth, guess, strict=True))
        total += len(truth)
    assert right / total > 0.97


def test_marked_and_plain_texts(field):
    for text, want in MARKED:
        labels = field.decode([M.chain(text)[1]])[0]
        assert labels.any(), text
        assert M.clean(text, field) == want
    for text in UNMARKED:
        assert text is None or not field.decode([M.chain(text)[1]])[0].any(), text


def test_structure_is_kept(field):
    got = M.clean("# Figure 3\n\nScale bar, 20 μm.\n\n- first item here\n- second item here\n\n```\nx = 1\n```", field)
    assert got.startswith("# Figure 3") and "- first item here\n- second item here" in got and "```\nx = 1\n```" in got
    html = M.clean("<h3>Methods</h3>\n<p>Cells were <i>counted</i> twice.</p><ul><li>one (n&gt;3)</li><li>two</li></ul>", field)
    assert html.startswith("# Methods") and "Cells were counted twice." in html and "- one (n>3)\n- two" in html
    assert "$E = mc^2$" in M.clean("Here \\[ E = mc^2 \\] holds for all.", field)
    assert "marker | value" in M.clean("| marker | value |\n|---|---:|\n| A | 4 |\n\nScale bar.", field)


def test_look_alikes_of_more_scripts_and_repeated_texts(spark):
    texts = ["pꓳlyp", "Ꮋepatic", "cօlon", "Ⲥolon", "ᏣᎳᎩ", "ꓡꓲꓢꓴ", "Հայաստան", "TNFα", "α-actin"]
    rows = spark.createDataFrame([(i, "t", 0, t) for i, t in enumerate(texts)] * 2, "record_id bigint, text_field string, item int, text string")
    got = C.normalised(rows).collect()
    assert len(got) == 2 * len(texts)
    assert {r.record_id: r.text for r in got} == dict(enumerate(["pOlyp", "Hepatic", "colon", "Colon", *texts[4:]]))
    assert sorted(r.record_id for r in C.disguised(rows).collect()) == [0, 1, 2, 3]


CLEAN = {
    r"\frac{a}{b} is the ratio": r"$\frac{a}{b}$ is the ratio",
    r"E = \sum_{i=1}^n x_i": r"E = $\sum_{i=1}^n$ x_i",
    "<ul><li>two <b>bold</b> rest</li></ul>": "- two bold rest",
    r"\textbf{a \emph{b \textit{c \underline{d}}}} e": "a b c d e",
    "<pre>\nfor x in y:\n    if x &lt; 3:\n\n        f_1(x)\n</pre> and more": "```\nfor x in y:\n    if x < 3:\n\n        f_1(x)\n```\nand more",
    "```python\ndef f(x):\n   return  x\n```\nText after": "```python\ndef f(x):\n   return  x\n```\n\nText after",
    "== Methods ==": "# Methods",
    "**a _b ~~c `d` e~~ f_ g**": "a b c `d` e f g",
    r"\section{Results \textbf{now}} We saw \cite{a} 5\% and $x_1$.": "# Results now\nWe saw 5% and $x_1$.",
    "\\begin{tabular}{ll}\nA & 4 \\\\\nB & 5\n\\end{tabular}": "A | 4\nB | 5",
    "use <code>a  b</code> here": "use `a  b` here",
    r"\textbf{never closed": "never closed",
    r"\href{http://x.y/z}{the site} shows": "the site shows",
    "<h2>Head <i>it</i> on</h3><p>body</p>": "# Head it on\nbody",
    "- one **b** two\n- three": "- one b two\n- three",
}


def test_structure_of_texts_unlike_the_pages(field):
    assert {text: M.clean(text, field) for text in CLEAN} == CLEAN


def test_every_kind_of_markup_passes_the_gate(field):
    """Texts with one leaf of each kind are cut into leaves, none is taken as plain unseen."""
    samples = {
        "comment": "<!-- a -->", "tag": "<b>", "broken": "</b", "escaped": "&lt;i&gt;", "entity": "&nbsp;", "fence": "```x```", "tick": "`x`",
        "head": "# x", "wikihead": "== x ==", "setext": "x\n---", "wikitable": "{| x |}", "row": "|x|", "bullet": "+ x", "number": "1. x",
        "quote": "> x", "link": "[x](y)", "wikilink": "[[x]]", "template": "{{x}}", "wikimark": "''x", "env": "\\begin{math}x\\end{math}",
        "display": "\\(x\\)", "dollar": "$x$", "command": "\\item", "escape": "\\%", "strong": "**x**", "em": "_x_", "strike": "~~x~~",
        "newline": "\n", "sign": "<",
    }
    assert set(samples) == set(M._LEAF.groupindex)
    for kind, text in samples.items():
        assert kind in [x.kind for x in M.leaves(text)], kind
        assert M._label_batch(pa.array([text]), field)[0][1], kind


def test_deep_and_unclosed_marks(field):
    deep = "".join(f"\\emph{{w{k} " for k in range(3000)) + "}" * 2000
    assert "emph" not in M.clean(deep, field) and "w2999" in M.clean(deep, field)
    assert M.clean("a \ue000 <b>b</b> \ue0007\ue001", field) == "a \ue000 b \ue0007\ue001"


def test_leaves_make_up_the_text():
    for page in M.labelled_pages(100, seed=5):
        text = "".join(t for t, _ in page)
        assert "".join(x.text for x in M.leaves(text)) == text


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    field = M.Field({}, np.random.default_rng(0).normal(size=(9, 9)))
    key = ("text", "short", "", False)
    scores = np.random.default_rng(1).normal(size=(4, 9))
    keys = [(key, (str(t),) * 4) for t in range(4)]
    field.cache = dict(zip(keys, scores, strict=True))
    best = max(itertools.product(range(9), repeat=4), key=lambda p: sum(scores[t][y] for t, y in enumerate(p)) + sum(field.steps[a, b] for a, b in zip(p, p[1:], strict=False)))
    assert field.decode([keys])[0].tolist() == list(best)


def test_markup_of_records(spark, field):
    rows = spark.createDataFrame(
        [(1, "<b>x</b> y", ["plain"], "a"), (2, "plain", ["a", None, "**b** c"], "a"), (3, None, None, "a"), (4, "", [], "a"), (5, "H&E", ["<i>a</i>", "<i>b</i>"], "a")],
        "record_id bigint, caption string, reference_texts array<string>, text string",
    )
    got = sorted((r.record_id, r.text_field) for r in M.with_markup(rows, field).collect())
    assert got == [(1, "caption"), (2, "reference_texts"), (5, "reference_texts")]
    assert M.with_markup(rows.limit(0), field).count() == 0
    clean = {(r.record_id, r.text_field, r.item): (r.text, r.has_markup) for r in M.cleaned(C.text_items(rows, {"caption": False, "reference_texts": True}), field).collect()}
    assert clean[(1, "caption", 0)] == ("x y", True) and clean[(3, "caption", 0)] == (None, False) and clean[(2, "reference_texts", 2)] == ("b c", True)


def test_long_texts(field):
    text = "<b>" + "word & more < less " * 20000 + "</b>"
    labels = M._label_batch(pa.array([text, "x" * 500_000]), field)
    assert labels[0][2].any() and not labels[1][2].any()
