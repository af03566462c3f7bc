import glob
import os

import pytest
from pyspark.sql import functions as F

from figcurate.operators import compaction as C

STORES = [("singlepanel", "/d/single/", 100, 250), ("subfigure", "/d/sub/", 50, 100)]


def stores(spark):
    return spark.createDataFrame(STORES, "store_name string, root_dir string, small_below_bytes bigint, target_bytes bigint")


def files(spark, rows):
    return spark.createDataFrame(rows, "file_id bigint, store_name string, stored_path string, n_bytes bigint, pmcid string")


def test_small_files(spark):
    listing = files(spark, [
        (5, "singlepanel", "/d/single/a.jpg", 10, "x"), (3, "singlepanel", "file:///d/single/./a.jpg", 10, "x"),
        (6, "singlepanel", "/d/single/b.jpg", 0, "x"), (7, "singlepanel", "/d/single/c.jpg", 100, "x"),
        (8, "singlepanel", "/d/single/unnamed.jpg", 10, "x"), (9, "subfigure", "/d/sub/p%201.png", 49, "x"), (10, "subfigure", None, 1, "x"),
    ])
    records = spark.createDataFrame([("a.jpg",), ("./b.jpg",), ("c.jpg",), ("",), (None,), ("a.jpg",)], "path string")
    named = C.named_places(records, "path", "singlepanel", stores(spark)).unionByName(
        C.named_places(spark.createDataFrame([("p 1.png",)], "path string"), "path", "subfigure", stores(spark))
    )
    got = sorted(r.file_id for r in C.small_files(listing, stores(spark), named).collect())
    assert got == [3, 9]
    assert C.small_files(listing.limit(0), stores(spark), named).count() == 0
    clashing = listing.withColumns({c: F.lit("x") for c in ("root_dir", "place", "small_below_bytes", "target_bytes", "bucket")})
    assert sorted(r.file_id for r in C.small_files(clashing, stores(spark), named).collect()) == [3, 9]


def test_plan_holds_every_file_once(spark):
    small = spark.range(1000).select(
        F.lit("s").alias("store_name"), F.col("id").alias("file_id"), F.concat(F.lit("/d/"), "id").alias("place"),
        (F.col("id") % 40 + 1).alias("n_bytes"), F.lit(1000).alias("target_bytes"),
    )
    plan = C.consolidation_plan(small).collect()
    assert sorted(r.file_id for r in plan) == list(range(1000))
    total, ends = {}, {}
    for r in sorted(plan, key=lambda r: (r.container_id, r.offset_bytes)):
        assert r.offset_bytes == ends.get(r.container_id, 0)
        ends[r.container_id] = r.offset_bytes + r.n_bytes
        total[r.container_id] = total.get(r.container_id, 0) + r.n_bytes
    assert all(600 <= v <= 1600 for v in total.values())
    assert C.consolidation_plan(small.limit(0)).count() == 0


def make(spark, path):
    table = C.SnapshotTable(spark, path, ["p"])
    for k in range(3):
        table.append(spark.range(k * 100, k * 100 + 100).select("id", (F.col("id") % 2).alias("p")).repartition(4))
    return table


def test_only_crowded_partitions_are_rewritten(spark, tmp_path):
    table = make(spark, str(tmp_path))
    table.append(spark.createDataFrame([(1000, 7)], "id bigint, p bigint"))
    before = table.files()
    done = table.compact(1 << 20)
    assert set(done) == {"p=0", "p=1"} and set(done.values()) == {1}
    assert table.files()["p=7"] == before["p=7"]
    assert sorted(r.id for r in table.read().collect()) == [*range(300), 1000]
    assert table.compact(1 << 20) == {}  # nothing left to do
    assert sorted(r.id for r in table.read(table.version() - 1).collect()) == [*range(300), 1000]
    assert table.expire() > 0
    assert len(glob.glob(os.path.join(str(tmp_path), "data", "*", "*", "*.parquet"))) == 3
    assert sorted(r.id for r in table.read().collect()) == [*range(300), 1000]


def test_partitions_get_as_many_files_as_they_need(spark, tmp_path):
    table = C.SnapshotTable(spark, str(tmp_path), ["p", "q"])
    rows = spark.range(20000).select("id", F.md5(F.col("id").cast("string")).alias("v"), F.when(F.col("id") < 19000, "big one").alias("p"), (F.col("id") % 2).alias("q"))
    table.append(rows.repartition(6))
    size = sum(table.files()["p=big one/q=0"].values())
    done = table.compact(size // 3, size)
    assert set(done) == {"p=big one/q=0", "p=big one/q=1", "p=__HIVE_DEFAULT_PARTITION__/q=0", "p=__HIVE_DEFAULT_PARTITION__/q=1"}
    assert 2 <= done["p=big one/q=0"] <= 4 and done["p=__HIVE_DEFAULT_PARTITION__/q=0"] == 1
    assert table.read().exceptAll(rows).count() == 0 and table.read().count() == 20000


def test_conflicts_are_noticed(spark, tmp_path):
    table = make(spark, str(tmp_path))
    base = table.version()
    changed = {"p=0": dict(list(table.files()["p=0"].items())[:1])}
    table.append(spark.createDataFrame([(999, 1)], "id bigint, p bigint"))  # another partition: no conflict
    table._commit(base, changed, append=False)
    table.append(spark.createDataFrame([(998, 0)], "id bigint, p bigint"))
    with pytest.raises(C.Conflict):
        table._commit(base, changed, append=False)


def test_dynamic_overwrite_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    C.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string"), path, ["p"])
    C.overwrite_partitions(spark.createDataFrame([(3, "b")], "id int, p string"), path, ["p"])
    assert sorted((r.id, r.p) for r in spark.read.parquet(path).collect()) == [(1, "a"), (3, "b")]


def test_partitions_are_consolidated_by_themselves_where_they_fill_a_file(spark):
    rows = [("s", i, f"/d/hot/{i}", 10, 400) for i in range(300)] + [("s", 1000 + i, f"/d/{i // 2}/{i}", 10, 400) for i in range(100)] + [("t", 5000, "/t/x", 3, 400)]
    small = spark.createDataFrame(rows, "store_name string, file_id bigint, place string, n_bytes bigint, target_bytes bigint")
    plan = C.consolidation_plan(small)
    got = plan.collect()
    assert sorted(r.file_id for r in got) == sorted(r[1] for r in rows)
    assert {r.partition for r in got if r.file_id < 1000} == {"/d/hot"} and {r.partition for r in got if r.file_id >= 1000} == {""}
    assert not {r.container_id for r in got if r.partition} & {r.container_id for r in got if not r.partition}
    faults = {r.store_name: r for r in C.plan_faults(small, plan).collect()}
    assert all(tuple(faults[k])[1:] == (n, b, 0, 0, 0, 0) for k, n, b in (("s", 400, 4000), ("t", 1, 3)))
    lost = C.plan_faults(small, plan.where("file_id <> 7").unionByName(plan.where("file_id = 8"))).where("store_name = 's'").first()
    assert lost.missing == 1 and lost.twice == 1 and lost.gaps > 0


def test_files_move_into_their_containers(spark, tmp_path):
    root = tmp_path / "store"
    for i in range(40):
        (root / f"a{i % 3}").mkdir(parents=True, exist_ok=True)
        (root / f"a{i % 3}" / f"f {i}.bin").write_bytes(bytes([i]) * (i + 1))
    small = spark.createDataFrame([("s", i, f"{root}/a{i % 3}/f {i}.bin", i + 1, 300) for i in range(40)], "store_name string, file_id bigint, place string, n_bytes bigint, target_bytes bigint")
    table = C.SnapshotTable(spark, str(tmp_path / "table"), ["store_name", "container_id"])
    plan = C.consolidation_plan(small)
    C.consolidate(plan, small, str(root), table)
    got = {r.file_id: bytes(r.content) for r in table.read().collect()}
    assert got == {i: bytes([i]) * (i + 1) for i in range(40)}
    assert table.live().count() == plan.select("container_id").distinct().count()


def test_manifests_fold_and_types_stay(spark, tmp_path):
    table = C.SnapshotTable(spark, str(tmp_path), ["day", "p"])
    table.FOLD = 3
    for k in range(7):
        table.append(spark.createDataFrame([(k, "01", f"x:{k % 2}/y z%+")], "id bigint, day string, p string"))
    assert table.append(table.read().limit(0)) == 7
    assert any(n.startswith("state-") for n in table.store.names("_manifests"))
    assert sorted(map(tuple, table.read().collect())) == [(k, "01", f"x:{k % 2}/y z%+") for k in range(7)]
    assert set(table.compact(1 << 20).values()) == {1} and table.live().count() == 2
    table.append(spark.createDataFrame([(9, "01", None, 0.5)], "id bigint, day string, p string, more double"))
    rows = {r.id: r for r in table.read().collect()}
    assert len(rows) == 8 and rows[9].more == 0.5 and rows[9].p is None and rows[0].more is None and rows[0].day == "01"
    assert table.read(7).count() == 7 and table.expire() == 7 and table.read().count() == 8
