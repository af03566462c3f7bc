import pytest
from pyspark.sql import functions as F

from figcurate import schemas
from figcurate.operators import alignment, candidates, panels, recovery, resolve, summary


def order(spark, boxes, **limits):
    rows = spark.createDataFrame([("p", i, float(x), float(y), 1.0, 1.0) for i, x, y in boxes],
                                 "parent string, detector_index int, x1 double, y1 double, image_width double, image_height double")
    got = panels.reading_order(rows, ["parent"], **limits).collect()
    return {r.detector_index: r.panel_order for r in got}


def by_rule(boxes, threshold=0.05):
    rows, last = [], None
    for box in sorted(boxes, key=lambda b: (b[2], b[0])):
        if last is None or abs(box[2] - last) > threshold:
            rows.append([])
        rows[-1].append(box)
        last = box[2]
    flat = [b[0] for row in rows for b in sorted(row, key=lambda b: (b[1], b[2], b[0]))]
    return {name: k for k, name in enumerate(flat)}


def test_reading_order(spark):
    assert order(spark, [(0, 0.2, 0), (1, 0.1, 0.04), (2, 0, 0.08)]) == {2: 0, 1: 1, 0: 2}  # one chained row
    assert order(spark, [(0, 0, 0), (1, 0, 0.051)]) == {0: 0, 1: 1}
    assert order(spark, [(0, 0.5, 0.5), (1, 0, 0), (2, 0.5, 0), (3, 0, 0.5)]) == {1: 0, 2: 1, 3: 2, 0: 3}
    assert order(spark, [(0, 0.3, 0.2), (1, 0.3, 0.2)]) == {0: 0, 1: 1}  # ties keep the detector's order
    import random

    r = random.Random(1)
    for _ in range(5):
        boxes = [(i, r.choice([0, 0.1, 0.5, 0.52]), r.choice([0, 0.03, 0.06, 0.3, 0.34, 0.8])) for i in range(12)]
        assert order(spark, boxes) == by_rule(boxes)


def test_panel_counts(spark):
    rows = spark.createDataFrame([("a", "ready"), ("a", "ready"), ("b", "ready"), ("b", None)], "parent string, crop string")
    counts = panels.panel_counts(rows, ["parent"], F.col("crop") == "ready")
    parents = spark.createDataFrame([("a",), ("b",), ("c",)], "parent string")
    got = {r.parent: (r.panel_count, r.ready_count, r.separation_status) for r in panels.with_empty_parents(parents, counts, ["parent"]).collect()}
    assert got == {"a": (2, 2, "separated"), "b": (2, 1, "partial_crop_failure"), "c": (0, 0, "no_panels_detected")}


def test_contiguity_and_nesting(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), ("b", 2), ("c", 0), ("c", 0), ("d", None), ("d", 0)], "parent string, i int")
    assert {r.parent: r.contiguous for r in panels.contiguity(rows, ["parent"], "i").collect()} == {"a": True, "b": False, "c": False, "d": False}
    nested = {r.parent: [p.i for p in r.panels] for r in panels.nested(rows, ["parent"], ["i"], []).collect()}
    assert nested["a"] == [0, 1]


def test_chunks(spark):
    rows = spark.range(1003).select(F.format_string("k%05d", "id").alias("k"))
    got = sorted((r.k, r.shard) for r in panels.numbered_chunks(rows, "k", 100).collect())
    assert [s for _, s in got] == [i // 100 for i in range(1003)]


def test_batches(spark):
    rows = spark.createDataFrame([("s", 3, 0), ("s", 7, 1), ("s", 4, 2), ("s", 4, 3)], "g string, n int, place int")
    got = {r.place: r.batch for r in panels.packed_batches(rows, ["g"], "n", "place", 2, 8).collect()}
    assert got == {0: 0, 2: 0, 3: 1, 1: 2}
    big = spark.createDataFrame([("s", 50, 0), ("s", 1, 1)], "g string, n int, place int")
    assert {r.place: r.batch for r in panels.packed_batches(big, ["g"], "n", "place", 4, 8).collect()} == {1: 0, 0: 1}
    assert {r.batch for r in panels.packed_batches(big, ["g"], "n", "place", 4, None).collect()} == {0}
    with pytest.raises(ValueError):
        panels.packed_batches(rows, ["g"], "n", "place", 0, 8)


def media(spark, links, urls):
    a = spark.createDataFrame([("A", "F", i, h) for i, h in enumerate(links)], "article string, figure string, at int, href string")
    b = spark.createDataFrame([("A", u) for u in urls], "article string, url string")
    return a, b


def test_media_matches(spark):
    def best(links, urls):
        rows = resolve.match_links(*media(spark, links, urls), ["article"], ["figure"]).collect()
        return (rows[0].href, rows[0].media_url, rows[0].match_type) if rows else None

    both = ["s3://b/k/gr1.png", "s3://b/k/gr1.jpg"]
    assert best(["gr1.png"], both) == ("gr1.png", both[0], "basename")
    assert best(["gr1"], both) == ("gr1", both[1], "stem")
    assert best(["nothing", "gr1.PNG"], both) == ("gr1.PNG", both[0], "basename")
    assert best(["gr1", "gr2.jpg"], [*both, "s3://b/k/gr2.jpg"])[0] == "gr2.jpg"  # a full name goes first
    assert best(["JCB9806103.f1"], ["s3://b/k/jcb9806103.f1.gif"])[2] == "stem"
    assert best(["  "], both) is None and best(["x"], both) is None
    counts = resolve.candidate_counts(*media(spark, ["f1a", "f1b", "f1a.jpg"], ["u/f1a.jpg", "u/f1b.jpg"]), ["article"], ["figure"])
    assert counts.first().candidates == 2


def test_versions(spark):
    figures = spark.createDataFrame([("A", "1", "x"), ("A", "2", "y"), ("B", "1", "x"), ("C", "1", None), ("D", "1", "q")], "article string, figure string, href string")
    files = spark.createDataFrame([("A", 1, "x.jpg"), ("A", 2, "x.jpg"), ("A", 2, "y.jpg"), ("A", 3, "x.jpg"), ("B", 1, "x.gif"), ("B", 4, "x.gif"), ("C", 2, "z.jpg"), ("C", 5, "z.jpg")],
                                  "article string, version bigint, url string")
    declared = spark.createDataFrame([("A", 3), ("B", 1), ("C", None), ("D", 1)], "article string, declared bigint")
    got = {r.article: (r.version, r.method, r.candidates, r.coverage) for r in resolve.resolve_versions(figures, files, declared).collect()}
    assert got == {
        "A": (2, "media_match", 3, 2), "B": (1, "explicit_version", 2, 1), "C": (5, "latest_version_no_media_match", 2, 0),
        "D": (None, "metadata_not_found", 0, 0),
    }


def test_prepare_images(spark):
    figures = spark.createDataFrame(
        [("A", "1", 2, ["x.jpg", "w.jpg"]), ("A", "2", 2, [" ", "y"]), ("A", "3", 2, []), ("B", "1", None, ["x"]), ("A", "4", 2, ["none"])],
        "article string, figure_id string, declared bigint, hrefs array<string>",
    )
    metadata = spark.createDataFrame([("A", 1, ["u/x.jpg"], "CC BY", False), ("A", 2, ["u/x.jpg", "u/y.png"], "CC0", True)],
                                     "article string, version bigint, media_urls array<string>, license_code string, is_retracted boolean")
    got = {(r.article, r.figure_id): (r.image_status, r.media_url, r.resolved_version) for r in resolve.prepare_images(figures, metadata, ["figure_id"]).collect()}
    assert got[("A", "1")] == ("found", "u/x.jpg", 2) and got[("A", "2")] == ("found", "u/y.png", 2)
    assert got[("A", "3")][0] == "missing_image_href" and got[("A", "4")][0] == "missing_from_metadata"
    assert got[("B", "1")] == ("metadata_not_found", None, None)


def test_alignment(spark):
    parents = spark.createDataFrame([("p", "one || two", 2, "stop"), ("q", "one", 2, "stop"), ("r", None, 1, None), ("s", "a||b", 2, "length")],
                                    "parent string, raw string, n int, reason string")
    judged = alignment.judged(parents, "raw", "n", "reason")
    got = {r.parent: (r.status, r.error) for r in judged.collect()}
    assert got["p"] == ("aligned", "") and got["q"] == ("count_mismatch", "Expected 2 subcaptions but parsed 1")
    assert got["r"][0] == "empty_prediction" and got["s"][0] == "generation_truncated"
    rows = spark.createDataFrame([("p", 1), ("p", 0), ("q", 0), ("s", 0)], "parent string, i int")
    joined = {(r.parent, r.i): r.subcaption for r in alignment.panel_captions(judged, rows, ["parent"], "i").collect()}
    assert joined == {("p", 0): "one", ("p", 1): "two"}
    few = alignment.parents_with_panels(parents.select("parent"), rows, ["parent"], least=2, most=3).collect()
    assert [(r.parent, r.n_panels) for r in few] == [("p", 2)]
    none = spark.createDataFrame([], "parent string")
    assert alignment.only_listed(parents, none, ["parent"]).count() == 0


def runs(spark):
    base = spark.createDataFrame([("a", "generation_truncated", 1), ("b", "aligned", 2), ("c", "count_mismatch", 3)], "parent string, status string, attempt_at int")
    one = spark.createDataFrame([("a", "aligned", 4, "x"), ("c", "empty_prediction", 5, "y")], "parent string, status string, attempt_at int, extra string")
    two = spark.createDataFrame([("b", "count_mismatch", 6), ("c", "aligned", 7)], "parent string, status string, attempt_at int")
    return recovery.attempts(base, [("r1", one), ("r2", two)], "base")


def test_retry_merge(spark):
    merged = recovery.merged(runs(spark), "parent", "status")
    got = {r.parent: (r.status, r.final_source, r.final_run, r.base_status, r.retry_attempts, r.latest_status, r.latest_run) for r in merged.collect()}
    assert got == {
        "a": ("aligned", "retry", "r1", "generation_truncated", 1, "aligned", "r1"),
        "b": ("aligned", "first_pass", "base", "aligned", 1, "count_mismatch", "r2"),
        "c": ("aligned", "retry", "r2", "count_mismatch", 2, "aligned", "r2"),
    }
    assert recovery.recovered(merged, "status").first().recovered == 2
    steps = {(r.previous, r.status): r.n for r in recovery.transitions(runs(spark), "parent", "status").collect()}
    assert steps == {("generation_truncated", "aligned"): 1, ("count_mismatch", "empty_prediction"): 1, ("aligned", "count_mismatch"): 1, ("empty_prediction", "aligned"): 1}
    counts = {r.run_name: r.replacements for r in recovery.replacements(runs(spark), "status", ["r1", "r2", "r3"]).collect()}
    assert counts == {"r1": 1, "r2": 1, "r3": 0}
    children = spark.createDataFrame([("a", "base", 1), ("a", "r1", 2), ("b", "base", 3), ("b", "r2", 4)], "parent string, run_name string, i int")
    assert sorted(r.i for r in recovery.rows_of_chosen_run(children, merged, "parent").collect()) == [2, 3]


def test_unknown_retry_parent(spark):
    stray = runs(spark).unionByName(runs(spark).where("run_order = 1").limit(1).withColumn("parent", F.lit("zz")))
    assert [r.parent for r in recovery.unknown_parents(stray, "parent").collect()] == ["zz"]
    assert recovery.merged(stray, "parent", "status").where("parent = 'zz'").count() == 0
    with pytest.raises(recovery.UnknownParent):
        recovery.merged(stray, "parent", "status", strict=True)
    with pytest.raises(ValueError):
        recovery.with_status(stray, "parent", "status", [])


def test_detection_and_routes(spark):
    rows = spark.createDataFrame([(0.500001, "ready"), (0.5, "ready"), (0.9, "gone"), (None, "ready")], "s double, image string")
    found = candidates.detected(rows, "s", F.col("image") == "ready")
    assert [(r.multipanel_label, r.is_multipanel, r.detection_status) for r in found.collect()] == [
        (1, True, "classified"), (0, False, "classified"), (None, None, "skipped_image_not_ready"), (None, None, "decode_failed"),
    ]
    assert {k: v.count() for k, v in candidates.routes(found, "is_multipanel").items()} == {"all": 4, "positive": 1, "negative": 1}
    kept = candidates.screened(rows, "s", 0.5)
    assert [r.retained for r in kept.collect()] == [True, True, True, None]
    assert candidates.retained_only(kept).count() == 3 and candidates.retained_only(rows).count() == 4


def test_candidates_are_one_table(spark):
    figures = schemas.conform(spark.createDataFrame([("PMC1", "abc.jpg", "cap")], "pmcid string, selected_image_href string, caption string"), schemas.DETECTION)
    rows = schemas.conform(spark.createDataFrame([("PMC1", "PMC1_abc_0", 0, "main")], "pmcid string, image_id string, subfigure_index bigint, caption string"), schemas.PANEL)
    panel_rows = schemas.extended(rows, schemas.ALIGNMENT_FIELDS)
    got = candidates.candidates(figures, panel_rows).collect()
    assert [(r.source_type, r.image_id, r.subfigure_index, r.caption, r.main_caption) for r in got] == [
        ("single_panel", "PMC1_abc", None, "cap", "cap"), ("subfigure", "PMC1_abc_0", 0, "", "main"),
    ]
    scored = candidates.classified(candidates.candidates(figures, None).withColumn("s", F.lit(0.5)), "s")
    assert schemas.conform(scored, schemas.OUTPUT).columns == schemas.OUTPUT.names and scored.first().is_medical is False
    with pytest.raises(ValueError):
        candidates.candidates(None, None)
    with pytest.raises(ValueError):
        candidates.classified(scored, "s", positive=2)


def test_summaries(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("b", 4), ("", 5)], "s string, i int")
    assert {r.value: r.n for r in summary.histogram(rows, F.col("s")).collect()} == {"b": 2, "a": 1, "": 2}
    assert list(summary.histogram_map(rows, F.col("s")).first().histogram.items()) == [("", 2), ("a", 1), ("b", 2)]
    assert summary.distinct_names(rows, "s").first().names == ["a", "b", "unrecorded"]
    assert summary.distinct_names(rows, "absent").first().names == ["unrecorded"]
    assert summary.last_per_key(rows, ["s"], ["i"]).where("s = 'b'").first().i == 4
    assert summary.first_per_key(rows, ["s"], ["i"]).where("s = 'b'").first().i == 1
    assert [r.i for r in summary.first_rows(rows, ["i"], 2).collect()] == [1, 2]
    assert summary.counters(rows, big=F.col("i") > 2, null=F.col("s") == "a").first().asDict() == {"rows": 5, "big": 3, "null": 1}


def test_schema_helpers(spark):
    rows = spark.createDataFrame([(None, 1)], "lang string, i int")
    filled = schemas.with_defaults(rows, {"lang": "xx", "more": 5}).first()
    assert filled.lang is None and filled.more == 5
    with pytest.raises(schemas.MissingColumns, match="x"):
        schemas.require(rows, ["i", "x"])
    assert schemas.unified([rows, rows.select("i")]).count() == 2


def test_spread(spark):
    from figcurate.session import spread

    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(10).repartition(50)
    assert spread(many) is many
    grouped = spark.range(10).groupBy("id").count()
    assert spread(grouped) is grouped


def test_missing_image_files_however_written(spark, tmp_path):
    from figcurate.plans import curation_queries

    stores = [("singlepanel", "/data/one/"), ("subfigure", "/data/two/")]
    files = [(1, "singlepanel", "/data/one/a/1.jpg"), (2, "singlepanel", "b//./2.jpg"), (3, "subfigure", "file:///data/two/3.jpg")]
    paths = ["a/1.jpg", "/data/one/a/1.jpg", "./x/../b/2.jpg", "/data/two/3.jpg", "3.jpg", "/a/1.jpg", "", None]
    tables = {
        "store_targets": spark.createDataFrame(stores, "store_name string, root_dir string"),
        "stored_files": spark.createDataFrame(files, "file_id bigint, store_name string, stored_path string").selectExpr("*", "1L AS n_bytes"),
        "singlepanel_records": spark.createDataFrame(list(enumerate(paths)), "record_id bigint, local_image_path string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    found = curation_queries.missing_image_files(spark, str(tmp_path))
    assert sorted(r.record_id for r in found.collect()) == [4, 5, 6, 7]


def test_eligibility_needs_all_that_is_known(spark):
    single = spark.createDataFrame(
        [("ready", "classified", False, "a.jpg"), ("ready", "classified", None, "a.jpg"), ("ready", "classified", False, ""), ("ready", None, False, "a.jpg"), ("gone", "classified", False, "a.jpg"), (None, None, None, None)],
        "image_status string, detection_status string, is_multipanel boolean, local_image_path string",
    )
    assert [r[0] for r in single.select(candidates.single_panel_is_eligible()).collect()] == [True] + [False] * 5
    parts = spark.createDataFrame(
        [("ready", "aligned", "p.png", "text"), ("ready", "aligned", "p.png", " \u3000"), ("ready", "aligned", None, "text"), ("failed", "aligned", "p.png", "text")],
        "crop_status string, caption_alignment_status string, local_panel_path string, subcaption string",
    )
    assert [r[0] for r in parts.select(candidates.subfigure_is_eligible()).collect()] == [True, False, False, False]


def test_articles_are_acquired_by_their_latest_version(spark):
    from figcurate.sources import articles

    wanted = spark.createDataFrame([(f"PMC{i}",) for i in (1, 2, 3, 4, 4)], "pmcid string")
    listed = spark.createDataFrame([("PMC1", 1), ("PMC1", 12), ("PMC2", 1), ("PMC4", 3), ("PMC9", 1), ("PMC3", None)], "pmcid string, version bigint")
    about = spark.createDataFrame(
        [("PMC1", 1, "CC BY", True), ("PMC1", 12, "cc-by 4.0: CC BY", False), ("PMC2", 1, "CC BY", True), ("PMC4", 3, "CC BY-ND", None)],
        "pmcid string, version bigint, license string, retracted boolean",
    )
    got = {r.pmcid: (r.version, r.status) for r in articles.acquired(wanted, listed, about).collect()}
    assert got == {"PMC1": (12, "downloaded"), "PMC2": (1, "retracted"), "PMC3": (None, "not_pmc_open_access"), "PMC4": (3, "license_not_allowed")}
    assert articles.acquired(wanted.limit(0), listed, about).count() == 0


def test_counters_of_an_empty_run_and_resumed_shards(spark):
    from figcurate.sources import sinks

    none = spark.createDataFrame([], "parent string, ok boolean")
    assert tuple(panels.separation_counters(none, ["parent"], F.col("ok")).first()) == (0, 0, 0, 0, 0)
    assert sinks.resume_mode([False] * 3) == "write" and sinks.resume_mode([True, False, True], overwrite=True) == "overwrite"
    assert sinks.resume_mode([True] * 3, resume=True) == "skip"
    for existing, resume in (([True, False, True], True), ([True] * 3, False)):
        with pytest.raises(FileExistsError):
            sinks.resume_mode(existing, resume=resume)
