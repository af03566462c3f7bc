import pytest
from pyspark.sql import functions as F

from figcurate.functions import text as T


def test_licences(values):
    rows = ["CC BY-NC-SA", "http://creativecommons.org/licenses/by/4.0/", "cc by-nc-nd", " cc_by ", "CC0 1.0", "Published by SAGE",
            "CC-BY 4.0", "none", "TDM", "", "  ", None, "no-cc code x"]
    want = ["CC BY-NC-SA", "CC BY", "CC BY-NC-ND", "CC-BY", "CC0", "CC BY-SA", "CC-BY 4.0", "NO-CC CODE", "TDM", None, None, None, "NO-CC CODE"]
    assert values(T.canonical_license(F.col("s")), "s string", [(x,) for x in rows]) == want
    assert [T.canonical_license_text(x) for x in rows] == want
    allowed = values(T.license_allowed(F.col("s")), "s string", [("CC BY",), ("CC BY-NC",), ("CC BY-ND",), (None,), ("NO-CC CODE",)])
    assert allowed == [True, True, False, False, False]
    assert T.allowed_licenses("") == frozenset()
    assert T.allowed_licenses("cc by, CC0") == {"CC BY", "CC0"}


def test_article_ids(values):
    rows = ["oa/PMC12.xml", "pmc7 x", "123", "PMC12_x", "", None, "abc"]
    assert values(T.pmcid_anywhere(F.col("s")), "s string", [(x,) for x in rows]) == ["PMC12", "PMC7", "PMC123", "PMC12", None, None, None]
    assert values(T.pmcid_prefix(F.col("s")), "s string", [(x,) for x in rows]) == ["PMC12", "PMC7", "", "PMC12", "", "", ""]
    pairs = [("PMC123", "1"), ("PMC123", "PMC123.2"), ("PMC123", ""), ("PMC123", ".03"), ("", "1"), ("PMC1", None), ("PMC1", "v2")]
    got = values(T.versioned_pmcid(F.col("a"), F.col("b")), "a string, b string", pairs)
    assert got == ["PMC123.1", "PMC123.2", "", "PMC123.3", "", "", ""]
    assert values(T.version_number(F.col("s")), "s string", [("PMC1.12",), ("PMC1",), ("",)]) == [12, -1, -1]


def test_media_names(values):
    rows = ["https://x/a/GR1.PNG?x=1#top", "a/b/", "JCB9806103.f1.gif", "gr%201.jpg", "a/./", "a+b.tif", "x/y?z", None]
    assert values(T.media_basename(F.col("s")), "s string", [(x,) for x in rows]) == [
        "gr1.png", "b", "jcb9806103.f1.gif", "gr 1.jpg", "a", "a+b.tif", "y?z", "",
    ]
    assert values(T.media_stem(F.col("s")), "s string", [("JCB.f1.gif",), ("a.f1",), ("x.jpeg",)]) == ["jcb.f1", "a.f1", "x"]
    assert values(T.media_rank(F.col("s")), "s string", [("a.jpg",), ("a.png",), ("a.f1",), ("a",)]) == [0, 2, 9, 9]
    assert values(T.graphic_id(F.col("s")), "s string", [("p/ABC.f1.JPG?x#y",), ("A.bmp",), (None,)]) == ["ABC.f1", "A", ""]


def test_image_ids(values):
    rows = [("PMC1", "ABC.f1.jpg", "", "F1"), ("", "a.jpg", None, "F1"), ("PMC1", None, None, None), ("PMC1", "", "x/y.bmp", "F")]
    parts = [F.col(c) for c in "abcd"]
    assert values(T.parent_image_id(*parts), "a string, b string, c string, d string", rows) == ["PMC1_ABC.f1", "_F1", "PMC1_figure", "PMC1_y.bmp"]
    assert values(T.single_image_id(*parts), "a string, b string, c string, d string", rows) == ["PMC1_ABC.f1", "a", "PMC1_figure", "PMC1_y"]


def test_object_addresses(values):
    got = values(T.object_url(F.col("s")), "s string", [("s3://bucket/k/a%20b.jpg?md5=ABCDEF",), ("http://x/y",), ("s3://b",), (None,)])
    assert tuple(got[0]) == ("bucket", "k/a b.jpg", "abcdef")
    assert got[1:] == [None, None, None]


def test_prompts(values):
    got = values(T.caption_prompt(F.col("c"), F.col("n")), "c string, n int", [("cap", 2), ("cap", 0)])
    assert got[0].endswith("# Compound Figure\n<IMAGE_TOKEN>\n# Subfigure\n<IMAGE_TOKEN>\n# Subfigure\n<IMAGE_TOKEN>\n# Main Caption\ncap")
    assert got[1] is None
    plain = values(T.caption_prompt(F.col("c"), F.col("n"), None), "c string, n int", [("cap", 3)])[0]
    assert "subfigures 0 through 2.\n# Main Caption\ncap" in plain and "IMAGE" not in plain
    refs = values(T.screening_input(F.col("c"), F.col("r")), "c string, r array<string>", [("a", ["x", "y"]), (None, None)])
    assert refs == ['"Caption": a\n"Reference Text": x\ny', '"Caption": \n"Reference Text": ']
    modes = [(["r"], ["c"]), (None, ["c"]), ([], ["c"]), (None, None)]
    pick = T.screening_references(F.col("o"), F.col("c"))
    assert values(pick, "o array<string>, c array<string>", modes) == [["r"], ["c"], [], []]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("(a) first || (b) second", ["(a) first", "(b) second"]),
        ("```\n(a) first || (b) second\n```", ["(a) first", "(b) second"]),
        ("```text\n a ||\n b\n```", ["a", "b"]),
        ("```x```", ["```x```"]),
        ("```\n```", []),
        ("  ", []),
        (None, []),
        ("a||", ["a", ""]),
    ],
)
def test_subcaptions(values, raw, want):
    assert values(T.subcaptions(F.col("s")), "s string", [(raw,)]) == [want]


def test_prediction_status(values):
    rows = [(["", "b"], 2, ""), (["a", "b"], 2, "Length"), ([], 2, None), (["a"], 2, "stop"), (["a", "b"], 2, "stop"), (None, 1, None)]
    got = values(T.prediction_status(F.col("p"), F.col("n"), F.col("f")), "p array<string>, n int, f string", rows)
    assert got == ["empty_subcaption", "generation_truncated", "empty_prediction", "count_mismatch", "aligned", "empty_prediction"]


def test_scores(values):
    import math

    got = values(T.positive_share(F.col("z")), "z array<float>", [([0.0, 0.0],), ([-1.0, 2.0],), ([1000.0, -1000.0],)])
    assert got[0] == 0.5 and abs(got[1] - 1 / (1 + math.exp(-3))) < 1e-9 and got[2] == 0.0
    assert values(T.label_above(F.col("s"), 0.5), "s double", [(0.500001,), (0.5,), (0.1,), (None,)]) == [1, 0, 0, None]
    assert values(T.reaches(F.col("s"), 0.5), "s double", [(0.5,), (0.49,), (None,)]) == [True, False, None]
    assert values(T.reaches(F.col("s"), 0.7), "s float", [(0.7,)]) == [False]  # a float widened, as the scores are stored
