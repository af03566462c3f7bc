from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from figcurate.functions import ids

WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      \u3000"


def test_strip_agrees_with_python(values):
    cases = [f"{a}x{b}y{c}" for a, b, c in zip(WHITE, WHITE[::-1], WHITE, strict=True)] + ["", WHITE, "x"]
    assert values(ids.strip(F.col("s")), "s string", [(c,) for c in cases]) == [c.strip() for c in cases]


def test_canonical_ids(values):
    spelled = ["PMC12", "pmc12", " PMC 12 ", "12", "Pmc12", "", None, "none"]
    assert values(ids.canonical_pmcid(F.col("s")), "s string", [(x,) for x in spelled]) == ["PMC12"] * 5 + [None] * 3
    images = [" PMC1_a.jpg", "PMC1_a", "PMC1_a.png ", "PMC1_fig 2.f1", "", "  ", None, ".jpg"]
    assert values(ids.canonical_image_id(F.col("s")), "s string", [(x,) for x in images]) == [
        "PMC1_a", "PMC1_a", "PMC1_a", "PMC1_fig 2.f1", None, None, None, None,
    ]


def test_versions(values):
    rows = [("PMC1.2", "3"), ("", ".7"), (None, "PMC1.011"), (" ", "4"), (None, None), ("", ""), ("PMC1", "x")]
    assert values(ids.current_version(F.col("a"), F.col("b")), "a string, b string", rows) == [2, 7, 11, 4, None, None, None]


def test_paths_that_lead_to_the_same_place(values):
    same = [
        "images/P/fig 1.jpg", "./images/P/fig 1.jpg", "images//P/./fig%201.jpg", "/d/s/images/P/fig 1.jpg",
        "file:///d/s/images/P/fig 1.jpg", "//d/s/images/P/fig 1.jpg", "/d/tmp/../s/images/P/fig 1.jpg", "/d/s/a/b/../../images/P/fig 1.jpg",
    ]
    got = values(ids.canonical_path(F.col("s"), F.lit("/d/s/")), "s string", [(x,) for x in same])
    assert set(got) == {"/d/s/images/P/fig 1.jpg"}
    others = ["", "  ", None, "a+b.png", "bad%zz.png", "/../../x"]
    assert values(ids.canonical_path(F.col("s"), F.lit("/d")), "s string", [(x,) for x in others]) == [
        None, None, None, "/d/a+b.png", "/d/bad%zz.png", "/x",
    ]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab./", min_size=1, max_size=12), min_size=20, max_size=20))
def test_paths_agree_with_normpath(values, paths):
    import posixpath

    got = values(ids.canonical_path(F.col("s"), F.lit("/r")), "s string", [(p,) for p in paths])
    want = [posixpath.normpath("/" + (p if p.startswith("/") else "/r/" + p).lstrip("/")) for p in paths]
    assert got == want
