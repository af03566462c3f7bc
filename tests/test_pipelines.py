"""The stages end to end with small stand-ins for the models."""

import pytest
from pyspark.sql import functions as F

from figcurate import cli, schemas
from figcurate.operators import candidates
from figcurate.plans import pipelines
from tests.test_sources import ARTICLE


def test_articles_to_screened_figures(spark):
    files = spark.createDataFrame([("a.xml", bytearray(ARTICLE.format(kind="pmcid"), "utf-8"), "PMC77"), ("b.xml", bytearray(b"<article/>"), "PMC78")],
                                  "path string, content binary, pmcid string")
    metadata = spark.createDataFrame([("PMC77", None, False), ("PMC78", "CC BY", True)], "pmcid string, license string, retracted boolean")
    figures = pipelines.extract(files, metadata, "pmcid")
    assert figures.count() == 2
    assert pipelines.extract(files, metadata, "pmcid", "CC0").count() == 0
    strict = metadata.withColumn("license", F.lit("CC BY-ND"))
    assert pipelines.extract(files, strict, "pmcid").count() == 0

    def factory():
        return lambda inputs: [0.9 if "Top." in x else 0.1 for x in inputs]

    routes = pipelines.screen(figures, factory, 0.5, model="m")
    assert [r.figure_id for r in routes["positive"].collect()] == ["F1"] and routes["negative"].count() == 1
    assert schemas.conform(routes["all"], schemas.SCREENED).columns == schemas.SCREENED.names
    meta = spark.createDataFrame([("PMC77", "2", ["s3://b/PMC77.2/A.f1.jpg?md5=AA"], "CC BY", False)],
                                 "pmcid string, version string, media_urls array<string>, license_code string, is_retracted boolean")
    row = pipelines.locate_images(routes["all"], meta).first()
    assert (row.image_status, row.local_image_path, row.image_expected_md5) == ("found", "images/PMC77.2/a.f1.jpg", "aa")


def test_figures_to_panels(spark):
    rows = [("PMC1", "F1", "a.jpg", 100, 200, "ready", "two boxes"), ("PMC1", "F2", "b.jpg", 10, 10, "ready", "none"), ("PMC1", "F3", "c.jpg", 10, 10, "ready", "broken"),
            ("PMC1", "F4", "d.jpg", None, None, "gone", "x")]
    figures = schemas.conform(spark.createDataFrame(rows, "pmcid string, figure_id string, selected_image_href string, image_width int, image_height int, image_status string, caption string"), schemas.DETECTION)
    routes = pipelines.detect(figures, "caption", lambda: lambda inputs: [0.9 for _ in inputs])
    assert routes["positive"].count() == 3 and routes["negative"].count() == 0

    def detector():
        def find(image):
            if image == "broken":
                raise RuntimeError("no")
            found = [dict(x1=50, y1=1, x2=90, y2=50, confidence=0.8), dict(x1=0, y1=0, x2=40, y2=50, confidence=0.9)]
            return found if image == "two boxes" else []

        return find

    parents, panels = pipelines.separate(schemas.conform(routes["positive"], schemas.DETECTION), "caption", detector)
    assert {r.parent_image_id: (r.separation_status, r.panel_count) for r in parents.collect()} == {
        "PMC1_a": ("separated", 2), "PMC1_b": ("no_panels_detected", 0), "PMC1_c": ("inference_failed", 0),
    }
    got = sorted(panels.collect(), key=lambda r: r.subfigure_index)
    assert [(r.image_id, r.detector_index, r.box_x1_normalized) for r in got] == [("PMC1_a_0", 1, 0.0), ("PMC1_a_1", 0, 0.5)]
    assert panels.columns == schemas.PANEL.names and got[0].panel_width > 40


def panel_rows(spark):
    rows = [(p, i, f"caption of {p}" if p != "none" else " ", f"{p}_{i}.png", f"{p}.png") for p in ("good", "cut", "bad", "none") for i in (1, 0)]
    return spark.createDataFrame(rows, "parent_image_id string, subfigure_index bigint, caption string, local_panel_path string, parent_local_image_path string")


def stand_in():
    """A factory of a backend; defined inside, so that workers need not import this module."""

    def backend(requests, limit):
        if any(r["request_id"] == "bad" for r in requests):
            raise RuntimeError("out of memory")
        out = {}
        for r in requests:
            name = r["request_id"]
            assert r["image_paths"] == [f"{name}.png", f"{name}_0.png", f"{name}_1.png"]
            cut = name == "cut" and limit < 1000
            out[name] = {"text": "first || sec" if cut else "first || second", "finish_reason": "length" if cut else "stop"}
        return out

    return lambda: backend


def test_captions_retry_and_merge(spark):
    base = pipelines.align(panel_rows(spark), stand_in(), "base", max_new_tokens=512)
    status = {r.parent_image_id: r.status for r in base["parents"].collect()}
    assert status == {"good": "aligned", "cut": "generation_truncated", "bad": "inference_failed", "none": "missing_main_caption"}
    assert sorted((r.parent_image_id, r.subfigure_index, r.subcaption) for r in base["subfigures"].collect()) == [("good", 0, "first"), ("good", 1, "second")]
    again = pipelines.retry(base, panel_rows(spark), stand_in(), "again", ["generation_truncated"], max_new_tokens=2048)
    assert [r.parent_image_id for r in again["parents"].collect()] == ["cut"]
    both = pipelines.merge(("base", base), [("again", again)])
    final = {r.parent_image_id: (r.status, r.final_source, r.base_status, r.retry_attempts) for r in both["parents"].collect()}
    assert final["cut"] == ("aligned", "retry", "generation_truncated", 1) and final["good"] == ("aligned", "first_pass", "aligned", 0)
    assert both["subfigures"].count() == 4 and both["raw"].where("retained_in_final_output").count() == 2
    assert [tuple(r) for r in both["transitions"].collect()] == [("generation_truncated", "aligned", 1)]
    inline = pipelines.align(panel_rows(spark), stand_in(), "base", max_new_tokens=512, retry_tokens=1024)
    assert {r.parent_image_id: r.attempts for r in inline["parents"].where("status = 'aligned'").collect()} == {"good": 1, "cut": 2}
    none = pipelines.align(panel_rows(spark), stand_in(), "x", only=panel_rows(spark).limit(0))
    assert none["parents"].count() == 0
    with pytest.raises(ValueError):
        pipelines.retry(base, panel_rows(spark), stand_in(), "again", [])


def test_final_decision(spark):
    figures = schemas.conform(spark.createDataFrame([("PMC1", "a.jpg", "yes"), ("PMC1", "b.jpg", "no"), ("PMC1", "c.jpg", "bad")], "pmcid string, selected_image_href string, local_image_path string"), schemas.DETECTION)

    def factory():
        return lambda inputs: [{"yes": 0.9, "no": 0.5}[x] for x in inputs]

    routes = pipelines.classify(candidates.candidates(figures, None), "local_image_path", factory)
    assert routes["all"].columns == schemas.OUTPUT.names
    assert {k: v.count() for k, v in routes.items()} == {"all": 3, "positive": 1, "negative": 1}
    failed = routes["all"].where("medical_classification_status = 'decode_failed'").first()
    assert failed.medical_classification_error.startswith("KeyError") and failed.is_medical is None


def test_command_line(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "local_session", lambda: spark)
    (tmp_path / "xml").mkdir()
    (tmp_path / "xml" / "PMC77.xml").write_text(ARTICLE.format(kind="pmcid"))
    assert cli.main(["extract-folder", str(tmp_path / "xml"), str(tmp_path / "out")]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    assert '"figures": 2' in (tmp_path / "out_summary.json").read_text()
    with pytest.raises(SystemExit):
        cli.main(["unknown"])
