import io
import json
import os
import struct
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from figcurate.operators import scoring
from figcurate.sources import articles, fetch, images, jats, sinks

ARTICLE = """<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><journal-meta><journal-title>J</journal-title></journal-meta>
<article-meta><article-id pub-id-type="{kind}">PMC77</article-id><article-id pub-id-type="pmid">9</article-id>
<title-group><article-title>On <i>Na</i>
 things</article-title></title-group>
<permissions><license license-type="open-access"><license-p>x</license-p></license></permissions>
<custom-meta-group><custom-meta><meta-name>pmc-license-ref</meta-name><meta-value>CC BY</meta-value></custom-meta></custom-meta-group>
</article-meta></front>
<body><p>We show Na<sub>2</sub>C<sub>2</sub>O<sub>4</sub> in <xref ref-type="FIG" rid="F1 F2">Figure 1</xref>.
<fig id="F1"><label>Figure 1</label><caption><title>Top.</title><p>First &amp; last. <p>inner</p></p></caption>
<graphic xlink:href="a.f1"/><graphic xlink:href="b"/><graphic xlink:href="a.f1"/></fig></p>
<p>See <xref ref-type="fig" rid="F1">it</xref>.</p><p>See <xref ref-type="fig" rid="F1">it</xref>.</p>
<fig><label>L</label></fig><fig><caption>bare text</caption></fig></body></article>"""


def test_figures_of_an_article():
    rows = jats.figures_of(ARTICLE.format(kind="pmcid").encode(), "a.xml")
    assert [r["figure_id"] for r in rows] == ["F1", "fig-0003"]
    first = rows[0]
    assert (first["pmcid"], first["pmid"], first["license"], first["article_title"]) == ("PMC77", "9", "CC BY", "On Na things")
    assert first["caption"] == "Top. First & last. inner" and first["figure_label"] == "Figure 1" and first["image_hrefs"] == ["a.f1", "b"]
    assert first["reference_texts"] == ["We show Na2C2O4 in Figure 1.", "See it."]
    assert "Top." in first["reference_texts_screening"][0] and first["reference_texts_screening"][1] == "See it."
    assert rows[1]["caption"] == "bare text" and rows[1]["reference_texts_screening"] is None
    assert jats.figures_of(ARTICLE.format(kind="pmc").encode())[0]["pmcid"] == "PMC77"
    every = jats.figures_of(ARTICLE.format(kind="pmc").encode(), require_caption=False)
    assert [r["figure_id"] for r in every] == ["F1", "fig-0002", "fig-0003"]
    given = jats.figures_of(ARTICLE.format(kind="pmc").encode(), metadata={"pmcid": "8", "license": "cc0", "title": "T", "article_version": "PMC8.2"})[0]
    assert (given["pmcid"], given["license"], given["article_title"], given["article_version"]) == ("PMC8", "CC0", "T", "PMC8.2")


def test_broken_articles_are_recovered(spark):
    broken = b"<article><body><p>See <xref ref-type='fig' rid='F1'>1</xref> & more<fig id='F1'><caption><p>Cap</caption></fig></body>"
    assert jats.figures_of(broken)[0]["parsed"] == "recovered" and jats.figures_of(broken)[0]["caption"] == "Cap"
    rows = spark.createDataFrame([("a", bytearray(broken)), ("b", bytearray(b"plain")), ("c", None)], "path string, content binary")
    got = jats.parse_articles(rows, keep_failures=True).collect()
    assert sorted((r.source_xml, r.parsed) for r in got) == [("a", "recovered"), ("b", "failed"), ("c", "failed")]
    assert jats.parse_articles(rows).count() == 1


def test_folders_archives_and_sidecars(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    for name in ("PMC2", "PMC1"):
        (folder / f"{name}.xml").write_text(ARTICLE.format(kind="pmcid"))
    (folder / "note.txt").write_text("x")
    assert [r.stem for r in articles.xml_folder(spark, str(folder), 1).collect()] == ["PMC1"]
    side = tmp_path / "json"
    side.mkdir()
    (side / "PMC1.json").write_text(json.dumps({"pmcid": "PMC1", "version": "3", "license_code": "CC BY-ND", "is_retracted": True}))
    (side / "PMC2.json").write_text("{bad")
    known = {r.stem: r for r in articles.sidecars(spark, str(side)).collect()}
    assert known["PMC1"].metadata.article_version == "PMC1.3" and known["PMC1"].retracted is True
    assert known["PMC2"].metadata.pmcid is None and known["PMC2"].retracted is False
    joined = articles.xml_folder(spark, str(folder)).join(articles.sidecars(spark, str(side)), "stem", "left")
    usable = joined.where(~F.col("retracted"))
    assert {r.pmcid for r in jats.parse_articles(usable).collect()} == {"PMC77"}
    with tarfile.open(tmp_path / "pack.tar.gz", "w:gz") as archive:
        for name in ("d/PMC5.xml", "d/PMC6.XML", "d/read.me"):
            data = ARTICLE.format(kind="pmcid").encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    got = articles.xml_archives(spark, str(tmp_path / "pack.tar.gz"))
    assert [(r.path, r.pmcid) for r in got.collect()] == [("d/PMC5.xml", "PMC5"), ("d/PMC6.XML", "PMC6")]
    assert articles.xml_archives(spark, str(tmp_path / "pack.tar.gz"), 1).count() == 1
    assert jats.parse_articles(got).count() == 4


def test_lists(spark, tmp_path):
    ids = tmp_path / "ids.txt"
    ids.write_text("# head\nPMC3\n\n pmc1 \n3\nnone\n")
    assert sorted((r.at, r.pmcid) for r in articles.id_list(spark, str(ids)).collect()) == [(1, "PMC3"), (3, "PMC1")]
    listing = tmp_path / "files.csv"
    listing.write_text('made today\nFile,Citation,Accession ID,License,Retracted\na/1.gz,"A, ""b""",PMC1,CC BY,no\nb,,PMC2,NO-CC CODE,YES\n'
                       "c,,PMC1,cc0,\noa/PMC9.tar.gz,,,CC BY,0\n")  # fmt: skip
    got = {r.pmcid: r for r in articles.file_list(spark, str(listing)).collect()}
    assert set(got) == {"PMC1", "PMC2", "PMC9"} and got["PMC1"].license == "CC0" and got["PMC2"].retracted is True
    tabbed = tmp_path / "files.txt"
    tabbed.write_text("Article File\tPMCID\tLicense Type\nx\tPMC4\tCC BY\n")
    assert articles.file_list(spark, str(tabbed)).first().license == "CC BY"
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        articles.file_list(spark, str(bad))
    prefixes = spark.createDataFrame([("PMC1.2/",), ("PMC1.10/",), ("PMC1/",), (None,)], "prefix string")
    assert [tuple(r) for r in articles.latest_versions(prefixes).collect()] == [("PMC1", 10)]
    meta = spark.createDataFrame([("PMC1", "CC BY", False), ("PMC2", "CC BY-ND", False), ("PMC3", None, True), ("PMC4", None, False)], "pmcid string, license string, retracted boolean")
    wanted = spark.createDataFrame([(f"PMC{i}",) for i in range(1, 6)], "pmcid string")
    assert sorted(r.pmcid for r in articles.usable_articles(wanted, meta, "pmcid").collect()) == ["PMC1", "PMC4", "PMC5"]


def png(width, height):
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + head + struct.pack(">I", zlib.crc32(b"IHDR" + head))


JPEG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x20\x00\x40\x03" + b"\0" * 12


def test_images(spark, tmp_path):
    assert images.read_header(png(3, 4)) == (3, 4, "PNG", "RGB")
    assert images.read_header(JPEG) == (64, 32, "JPEG", "RGB")
    assert images.read_header(b"GIF89a\x05\x00\x06\x00") == (5, 6, "GIF", "P")
    for bad in (b"", b"text", png(0, 3)):
        with pytest.raises(ValueError):
            images.read_header(bad)
    (tmp_path / "a.png").write_bytes(png(3, 4))
    (tmp_path / "b.jpg").write_bytes(b"nothing")
    (tmp_path / "c.txt").write_bytes(b"text")
    files = images.image_files(spark, str(tmp_path))
    assert files.count() == 2
    got = {r.path[-5:]: (r.width, r.error) for r in images.inspected(files).collect()}
    assert got == {"a.png": (3, ""), "b.jpg": (None, "unknown image format")}


def test_downloads_resume_and_verify(spark, tmp_path):
    data = b"0123456789" * 10
    asked = []

    def opener(url, start):
        asked.append(start)
        if url == "bad":
            raise OSError("gone")
        return (start, io.BytesIO(data[start:])) if url == "range" else (0, io.BytesIO(data))

    target = str(tmp_path / "x" / "f")
    os.makedirs(os.path.dirname(target))
    for url in ("range", "whole"):
        with open(target + ".part", "wb") as f:
            f.write(data[:30])
        how, digest = fetch.download(url, target, opener)
        assert how == "downloaded" and open(target, "rb").read() == data and not os.path.exists(target + ".part")
        assert fetch.download(url, target, opener, md5=digest.upper())[0] == "reused"
        os.unlink(target)
    assert asked == [30, 30]
    with pytest.raises(ValueError):
        fetch.download("range", target, opener, md5="00")
    assert not os.path.exists(target)


def test_sinks(spark, tmp_path):
    rows = spark.range(25).select("id", F.when(F.col("id") > 3, F.lit(True)).alias("ok"))
    sinks.write_table(rows.coalesce(1), str(tmp_path / "t"), rows_per_file=10)
    assert len([n for n in os.listdir(tmp_path / "t") if n.endswith(".parquet")]) == 3
    assert sinks.read_parts(spark, str(tmp_path / "t")).count() == 25
    sinks.write_table(rows.limit(0), str(tmp_path / "empty"))
    assert sinks.read_parts(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(FileNotFoundError):
        sinks.read_parts(spark, str(tmp_path / "none"))
    sinks.write_jsonl(spark.createDataFrame([("a", 1), ("", 2)], "k string, v int"), str(tmp_path / "j"))
    sinks.write_jsonl(spark.createDataFrame([("b", 3)], "k string, v int"), str(tmp_path / "j"), mode="append")
    assert {r.k: r.v for r in sinks.read_jsonl(spark, str(tmp_path / "j"), "k").collect()} == {"a": 1, "b": 3}
    assert sinks.read_jsonl(spark, str(tmp_path / "no"), "k", "k string").count() == 0
    got = sinks.write_summary(rows.agg(F.count("*").alias("n"), F.lit("é").alias("s")), str(tmp_path / "s.json"))
    assert got["n"] == 25 and "é" in (tmp_path / "s.json").read_text()
    assert sinks.same_settings(spark, str(tmp_path / "s.json"), n=25) and not sinks.same_settings(spark, str(tmp_path / "s.json"), n=1)
    sinks.check_settings(rows.withColumn("threshold", F.lit(0.5)), threshold=0.5, other=1)
    with pytest.raises(sinks.OtherSettings):
        sinks.check_settings(rows.withColumn("threshold", F.lit(0.5)), threshold=0.6)
    sinks.write_routes({"a": rows, "b": rows.limit(1)}, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r" / "b")).count() == 1


def test_scorers_isolate_bad_inputs(spark):
    def factory():
        def score(inputs):
            if "bad" in inputs:
                raise RuntimeError("no")
            return [len(x) / 10 for x in inputs]

        return score

    rows = spark.createDataFrame([("a",), ("bad",), (None,), ("abc",)], "t string").coalesce(1)
    got = [(r.score, r.score_error) for r in scoring.with_scores(rows, "t", factory).collect()]
    assert [None if s is None else round(s, 2) for s, _ in got] == [0.1, None, None, 0.3]
    assert [e for _, e in got] == ["", "RuntimeError: no", "", ""]


def test_failures_are_kept_apart():
    calls = []

    def backend(rows, limit):
        names = [r["request_id"] for r in rows]
        calls.append(names)
        if "bad" in names:
            raise RuntimeError("x")
        return {n: {"text": "ok"} for n in names if n != "lost"}

    got = scoring.answers(backend, [{"request_id": n} for n in ("g1", "bad", "g2", "lost")])
    assert {n: (a.get("text"), a.get("error")) for n, a in got.items()} == {
        "g1": ("ok", None), "bad": (None, "RuntimeError: x"), "g2": ("ok", None), "lost": (None, "LookupError: no result for lost"),
    }
    assert calls[0] == ["g1", "bad", "g2", "lost"] and scoring.answers(backend, []) == {}
    calls.clear()
    scoring.answers(backend, [{"request_id": n} for n in ("g1", "g2", "lost")])
    assert calls == [["g1", "g2", "lost"], ["lost"]]  # what was answered is not asked twice
    run = scoring.per_request(lambda prompt, paths: prompt.upper() if prompt else 1 / 0)
    got = run([{"request_id": "a", "prompt": "x", "image_paths": []}, {"request_id": "b", "prompt": "", "image_paths": []}], None)
    assert got == {"a": {"text": "X"}, "b": {"error": "ZeroDivisionError: division by zero"}}


def test_cut_predictions_are_asked_again(spark):
    def factory():
        def backend(rows, limit):
            whole = {r["request_id"]: limit > 600 or r["prompt"] == "short" for r in rows}
            return {n: {"text": "one || two" if w else "one |", "finish_reason": "stop" if w else "length", "generate_token_len": limit} for n, w in whole.items()}

        return backend

    rows = spark.createDataFrame([("a", "long", ["p"]), ("b", "short", None)], "request_id string, prompt string, image_paths array<string>")
    got = {r.request_id: r for r in scoring.with_predictions(rows, factory, 4, 512, 1024).collect()}
    assert (got["a"].text, got["a"].attempts, got["a"].initial_finish_reason, got["a"].finish_reason) == ("one || two", 2, "length", "stop")
    assert (got["b"].attempts, got["b"].max_new_tokens, got["b"].text) == (1, 512, "one || two")


def test_streamed_articles(spark, tmp_path):
    from figcurate.streaming.incremental import stream_articles

    folder = tmp_path / "in"
    folder.mkdir()
    paths = [str(tmp_path / n) for n in ("out", "checkpoint")]
    for k in range(2):
        (folder / f"PMC{k}.xml").write_text(ARTICLE.format(kind="pmcid"))
        stream_articles(spark, str(folder), *paths).awaitTermination()
    assert spark.read.parquet(paths[0]).count() == 4  # each article once
    assert sorted(n for n in os.listdir(paths[0]) if n.startswith("batch")) == ["batch=0", "batch=1"]


def test_tiff_and_webp_headers():
    import struct

    from figcurate.sources.images import read_header

    tags = [(256, 3, 640), (257, 4, 480), (262, 3, 2), (277, 3, 3)]
    for order, magic in (("<", b"II*\0"), (">", b"MM\0*")):
        body = b"".join(struct.pack(f"{order}HHI", t, k, 1) + (struct.pack(f"{order}HH", v, 0) if k == 3 else struct.pack(f"{order}I", v)) for t, k, v in tags)
        assert read_header(magic + struct.pack(f"{order}IH", 8, len(tags)) + body) == (640, 480, "TIFF", "RGB")
    riff = b"RIFF\0\0\0\0WEBP"
    extended = riff + b"VP8X\x0a\0\0\0\x10\0\0\0" + (639).to_bytes(3, "little") + (479).to_bytes(3, "little")
    lossless = riff + b"VP8L\0\0\0\0\x2f" + (639 | 479 << 14).to_bytes(4, "little") + bytes(10)
    lossy = riff + b"VP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 640, 480)
    assert [read_header(x) for x in (extended, lossless, lossy)] == [(640, 480, "WEBP", m) for m in ("RGBA", "RGB", "RGB")]
    for broken in (b"II*\0", b"II*\0\xff\0\0\0", riff):
        with pytest.raises((ValueError, struct.error)):
            read_header(broken)


def test_newest_metadata_comes_first(spark):
    keys = spark.createDataFrame([(k,) for k in ("metadata/PMC7.2.json", "metadata/PMC7.10.json", "PMC7.2.json", "metadata/PMC7.json", "x/PMC8.1.json", "x/PMC8.1.json", None)], "key string")
    got = [(r.pmcid, r.version) for r in articles.metadata_listing(keys).collect()]
    assert got == [("PMC7", 10), ("PMC7", 2), ("PMC7", 2), ("PMC8", 1)]


def test_archive_and_list_are_fetched_together(spark, tmp_path):
    from figcurate.sources.fetch import bulk_pair

    def opener(url, start):
        import io

        return 0, io.BytesIO(url.encode())

    got = bulk_pair(spark, "http://h/a/b.tar.gz?x=1", "http://h/a/b.csv", str(tmp_path), opener)
    assert {u: open(p).read() for u, p in got.items()} == {u: u for u in got} and set(got.values()) == {f"{tmp_path}/b.tar.gz", f"{tmp_path}/b.csv"}
    with pytest.raises(ValueError):
        bulk_pair(spark, "http://h/a/", "http://h/a/b.csv", str(tmp_path), opener)
