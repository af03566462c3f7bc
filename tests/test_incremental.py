import pytest
from pyspark.sql import functions as F

from figcurate.operators import incremental as inc

SCHEMA = "pmcid string, figure_id string, resolved_article_version string, article_version string, pmcid2 string"


def tables(spark):
    records = spark.createDataFrame(
        [
            ("PMC1", "F1", "PMC1.2", None, "x"), (" pmc 1", "F1", "", "3", "x"), ("1", "F2", None, None, "x"),
            ("PMC2", "F1", "PMC2.01", "", "x"), (None, "F1", "1", "1", "x"), ("PMC3", " ", "1", "1", "x"), ("PMC2", "F1", "PMC2.1", "", "x"),
        ],
        SCHEMA,
    )
    runs = spark.createDataFrame(
        [(1, "2031-01-01 00:00:00", "succeeded"), (2, "2031-01-02 00:00:00", "failed"), (3, "2031-01-03 00:00:00", "running")],
        "run_id bigint, at string, run_status string",
    ).select("run_id", F.to_timestamp("at").alias("run_started_at"), F.lit(None).cast("timestamp").alias("run_ended_at"), "run_status")
    return records, runs


def ledger(spark, rows):
    return spark.createDataFrame(rows, "run_id bigint, pmcid string, figure_id string, processed_version string")


def test_current_version_is_the_greatest(spark):
    records, _ = tables(spark)
    got = {(r.pmcid, r.figure_id): r.version for r in inc.current_figures(records).collect()}
    assert got == {("PMC1", "F1"): 3, ("PMC1", "F2"): None, ("PMC2", "F1"): 1}


def test_states(spark):
    records, runs = tables(spark)
    history = ledger(spark, [(1, "PMC1", "F1", "PMC1.2"), (2, "pmc1", "F1", "3"), (3, "PMC1", "F1", "03"), (1, "2", "F1", "PMC2.1"), (1, "2", "F1", "1"), (9, "2", "F1", "1")])
    got = {(r.pmcid, r.figure_id): (r.state, r.token) for r in inc.work_items(records, history, runs).collect()}
    assert got == {("PMC1", "F1"): ("leased", 3), ("PMC1", "F2"): ("pending", None), ("PMC2", "F1"): ("done", 1)}
    open_items = {tuple(r) for r in inc.unhandled(records, history, runs).collect()}
    assert open_items == {("PMC1", "F1"), ("PMC1", "F2")}


def test_failed_runs_and_old_leases_give_items_back(spark):
    records, runs = tables(spark)
    history = ledger(spark, [(2, "PMC1", "F1", "3")])
    assert {r.state for r in inc.work_items(records, history, runs).collect()} == {"pending"}
    late = runs.unionByName(runs.limit(0)).withColumn("run_started_at", F.col("run_started_at") - F.expr("INTERVAL 30 DAYS"))
    late = late.unionByName(runs.where("run_id = 1").withColumn("run_id", F.lit(7).cast("bigint")))
    held = inc.work_items(records, ledger(spark, [(3, "PMC1", "F1", "3")]), late)
    assert {r.state for r in held.collect()} == {"pending"}


def test_clashing_columns(spark):
    records, runs = tables(spark)
    history = ledger(spark, [(1, "PMC1", "F1", "3")])
    more = {c: F.lit("x") for c in ("state", "token", "version", "succeeded", "held")}
    got = inc.work_items(records.withColumns(more), history.withColumns(more), runs.withColumns({**more, "pmcid": F.lit("y")}))
    assert {(r.pmcid, r.figure_id): r.state for r in got.collect()} == {("PMC1", "F1"): "done", ("PMC1", "F2"): "pending", ("PMC2", "F1"): "pending"}


def test_empty_tables(spark):
    records, runs = tables(spark)
    empty = ledger(spark, [])
    assert inc.unhandled(records, empty, runs.limit(0)).count() == 3
    assert inc.unhandled(records.limit(0), empty, runs).count() == 0


def test_ledger_life_cycle(spark, tmp_path):
    items = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "key string, version bigint")
    book = inc.WorkLedger(spark, str(tmp_path), ["key"])
    first, taken = book.claim(items, "one", 100, now=0)
    assert taken.count() == 3
    assert book.claim(items, "two", 100, now=50)[1].count() == 0  # all leased
    book.complete(first, items.where("key = 'a'"))
    third, again = book.claim(items, "three", 100, now=200)  # the lease ended, only a is done
    assert {r.key for r in again.collect()} == {"b", "c"} and third > first
    with pytest.raises(inc.StaleToken):
        book.complete(first, items.where("key = 'b'"))
    book.complete(third, items.where("key <> 'a'"))
    book.complete(third, items.where("key <> 'a'"))  # a repeated task changes nothing
    assert {(r.key, r.state) for r in book.states(items, now=201).collect()} == {(k, "done") for k in "abc"}
    newer = spark.createDataFrame([("a", 2)], "key string, version bigint")
    fourth, changed = book.claim(newer, "four", 100, now=300)
    assert changed.count() == 1
    book.fail(fourth)
    assert book.claim(newer, "five", 100, now=301)[1].count() == 1


def test_results_survive_failures_and_stale_writers(spark, tmp_path):
    items = spark.createDataFrame([("a", 1), ("b", 1)], "key string, version bigint")
    book, out = inc.WorkLedger(spark, str(tmp_path / "book"), ["key"]), str(tmp_path / "out")

    def handle(rows):
        return rows.withColumn("value", F.concat("key", F.lit("!")))

    def broken(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        book.process(items, "one", broken, out, 100, now=0)
    assert book.results(items, out).count() == 0
    # a writer that hangs: its output is there, but its lease ends before it completes
    slow, taken = book.claim(items, "slow", 100, now=200)
    handle(taken).write.parquet(book.output_path(out, slow))
    assert book.process(items, "next", handle, out, 100, now=250) is None  # still leased
    token = book.process(items, "next", handle, out, 100, now=400)
    with pytest.raises(inc.StaleToken):
        book.complete(slow, taken)
    rows = book.results(items, out).collect()
    assert sorted((r.key, r.value, r.token) for r in rows) == [("a", "a!", token), ("b", "b!", token)]
    assert book.process(items, "again", handle, out, 100, now=500) is None  # nothing is repeated
    newer = items.where("key = 'a'").withColumn("version", F.lit(2).cast("bigint")).unionByName(items.where("key = 'b'"))
    book.process(newer, "update", handle, out, 100, now=600)
    assert sorted((r.key, r.version) for r in book.results(newer, out).collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_null_versions_are_handled_once(spark, tmp_path):
    items = spark.createDataFrame([("a", None), (None, 1), ("b", 2)], "key string, version bigint")
    book, out = inc.WorkLedger(spark, str(tmp_path / "book"), ["key"]), str(tmp_path / "out")
    first, taken = book.claim(items, "one", 100, now=0)
    assert taken.count() == 3 and book.claim(items, "two", 100, now=1)[1].count() == 0  # one holder at a time
    third = book.process(items, "three", lambda rows: rows, out, 100, now=200)
    with pytest.raises(inc.StaleToken):
        book.complete(first, taken, now=201)
    assert book.process(items, "four", lambda rows: rows, out, 100, now=400) is None
    assert sorted((repr(r.key), repr(r.version), r.token) for r in book.results(items, out).collect()) == sorted(
        (repr(k), repr(v), third) for k, v in (("a", None), (None, 1), ("b", 2))
    )
    assert {r.state for r in book.states(items, now=500).collect()} == {"done"}


def landed(spark, rows):
    return spark.createDataFrame(rows, "key string, version bigint, day int").selectExpr("key", "version", "timestamp_seconds(day * 86400) AS landed_at")


def newest(rows):
    return rows.groupBy("key").agg(F.max("version").alias("version"))


def test_only_what_landed_is_read_and_claims_fold(spark, tmp_path):
    book, out = inc.WorkLedger(spark, str(tmp_path / "book"), ["key"]), str(tmp_path / "out")
    day1 = [("a", 1, 1), ("b", None, 1), ("c", 5, 1)]
    read = []

    def items(rows):
        read.append(rows.count())
        return newest(rows)

    run = lambda rows, now, **more: book.process_landed(landed(spark, rows), items, "r", lambda x: x, out, 100, now=now, **more)
    assert run(day1, 0) == 1
    day2 = [*day1, ("a", 2, 2), ("c", 4, 2), ("d", 1, 2)]  # c comes again in an older version
    lost, taken = book.claim_landed(landed(spark, day2), items, "dies", 100, now=10)
    assert sorted((r.key, r.version) for r in taken.collect()) == [("a", 2), ("d", 1)] and read == [3, 3]
    assert run(day2, 50) is None  # leased
    assert book.compact(taken, now=60) == 0  # the first lease has not ended
    day3 = [*day2, ("d", 2, 3)]
    token = run(day3, 200)
    assert read[-1] == 1
    got = {(r.key, r.version, r.token) for r in book.results(taken, out).collect()}
    assert got == {("a", 1, 1), ("b", None, 1), ("c", 5, 1), ("a", 2, token), ("d", 2, token)}
    assert book.compact(taken, now=400) >= token
    with pytest.raises(inc.StaleToken):
        book.complete(lost, taken, now=401)
    assert {(r.key, r.version, r.token) for r in book.results(taken, out).collect()} == got
    assert run(day3, 500) is None and read[-1] == 0
    assert run([*day3, ("b", None, 1), ("e", 1, 2)], 600) is None  # landed too late for what is read ...
    assert run([*day3, ("b", None, 1), ("e", 1, 2)], 700, late_seconds=2 * 86400) is not None  # ... unless it is allowed for
    assert run([("f", 1, None)], 800) is not None and run([("f", 1, None)], 900) is None


def test_a_late_writer_yields_to_a_claim_under_way(spark, tmp_path):
    items = spark.createDataFrame([("a", 1)], "key string, version bigint")
    book = inc.WorkLedger(spark, str(tmp_path), ["key"])
    first, taken = book.claim(items, "one", 100, now=0)
    book._new_token({"holder": "two", "lease_until": 500}, 200)  # its claims are not written yet
    with pytest.raises(inc.StaleToken):
        book.complete(first, taken, now=201)
    book.fail(first)
    book.fail(first)
    with pytest.raises(inc.StaleToken):
        book.complete(first, taken, now=50)
