import collections
import os
import re
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from figcurate.llm import components as K
from figcurate.llm import near_duplicates as N


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a string, b string")


def by_union(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    groups = collections.defaultdict(set)
    for x in list(parent):
        groups[find(x)].add(x)
    return sorted(map(sorted, groups.values()))


def components(spark, pairs):
    groups = collections.defaultdict(set)
    for r in K.connected_components(edges(spark, pairs)).collect():
        groups[r.component].add(r.node)
    assert all(name in members for name, members in groups.items())
    return sorted(map(sorted, groups.values()))


def test_chains_stars_and_random_graphs(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    star = [("hub", f"s{i}") for i in range(30)]
    r = np.random.default_rng(5)
    noise = [(f"n{a}", f"n{b}") for a, b in r.integers(0, 60, (45, 2)) if a != b]
    for pairs in (chain, star, noise, chain + star + noise):
        assert components(spark, pairs) == by_union(pairs)
    assert K.connected_components(edges(spark, []).limit(0)).count() == 0


RECORDS = [
    (1, "PMC1", "PMC1_a"), (2, "pmc1 ", " PMC2_b.jpg"), (3, "2", "PMC2_b"), (4, "PMC3", None), (5, None, "PMC2_b.png"), (6, None, "lone"),
    (7, None, None), (8, "", ""), (9, "PMC4", ""), (10, "PMC5", ""), (11, "PMC1", "PMC1_a"), (12, None, " lone.jpg"),
]


def records(spark, rows=RECORDS):
    return spark.createDataFrame(rows, "record_id bigint, pmcid string, parent_image_id string")


def test_articles_connected_by_images(spark):
    pairs = [tuple(r) for r in K.connected_pairs(K.article_components(records(spark))).collect()]
    assert pairs == [("PMC1", "PMC2")]
    groups = {r.record_id: r.group_id for r in K.record_groups(records(spark)).collect()}
    assert len(groups) == len(RECORDS)
    assert groups[1] == groups[2] == groups[3] == groups[5] == groups[11] and groups[6] == groups[12]
    assert len({groups[i] for i in (1, 4, 6, 7, 8, 9, 10)}) == 7
    assert K.article_components(records(spark).limit(0)).count() == 0


def test_splits(spark):
    rows = spark.range(6000).select(F.col("id").alias("record_id"), F.when(F.col("id") < 2000, "hot").otherwise((F.col("id") % 900).cast("string")).alias("group_id"))
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, share double")
    out = K.assign_splits(rows, targets)
    assert out.count() == 6000 and out.groupBy("group_id").agg(F.countDistinct("split_name").alias("n")).where("n > 1").count() == 0
    share = {r.split_name: r.n / 6000 for r in out.groupBy("split_name").agg(F.count("*").alias("n")).collect()}
    assert abs(share["train"] - 0.8) < 0.02 and abs(share["validation"] - 0.1) < 0.02 and abs(share["test"] - 0.1) < 0.02
    assert {tuple(r) for r in K.assign_splits(rows, targets).collect()} == {tuple(r) for r in out.collect()}
    assert K.assign_splits(rows.limit(0), targets).count() == 0


def similar(texts, least, share=0.8):
    bags = [(i, collections.Counter(re.findall(r"[^\W_]+", t.lower()))) for i, t in texts if t]
    bags = [(i, b, sum(b.values())) for i, b in bags if sum(b.values()) >= least]
    return {
        (min(i, j), max(i, j))
        for k, (i, a, n) in enumerate(bags)
        for j, b, m in bags[k + 1 :]
        if i != j and sum((a & b).values()) * 10 >= round(share * 10) * max(n, m)
    }


def found(spark, texts, least):
    rows = spark.createDataFrame(texts, "id bigint, text string")
    pairs = N.near_duplicate_pairs(*N.near_duplicate_classes(rows, min_words=least))
    return {tuple(r) for r in pairs.collect()}


@pytest.mark.parametrize(("least", "seed"), [(45, 1), (10, 2), (5, 3)])
def test_all_near_duplicates_are_found(spark, least, seed):
    r = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(300)] + ["the", "of", "and"] * 20
    texts = []
    for i in range(40):
        base = list(r.choice(words, size=int(r.integers(least, 2 * least + 5))))
        texts.append((i * 10, " ".join(base)))
        for k in range(1, 5):
            other = list(base)
            for _ in range(int(r.integers(0, len(base) // 3 + 1))):
                way, at = r.integers(0, 3), int(r.integers(0, max(1, len(other))))
                if way == 0 and other:
                    other.pop(min(at, len(other) - 1))
                elif way == 1:
                    other.insert(at, str(r.choice(words)))
                else:
                    r.shuffle(other)
            texts.append((i * 10 + k, " ".join(other).upper() if k == 2 else ", ".join(other)))
    texts += [(1000, None), (1001, ""), (1002, "too short"), (0, texts[0][1]), (1003, texts[0][1])]
    want = similar(texts, least)
    assert len(want) > 40 and found(spark, texts, least) == want


def test_long_texts_and_the_border_between_both_ways(spark):
    r = np.random.default_rng(8)
    words = [f"w{k}" for k in range(4000)]
    texts = []
    for i, n in enumerate((180, 205, 250, 256, 260, 310, 900, 30000)):
        base = list(r.choice(words, size=n))
        drop = int(n * 0.19)
        texts += [(10 * i, " ".join(base)), (10 * i + 1, " ".join(base[drop:])), (10 * i + 2, " ".join(base[: n - drop])), (10 * i + 3, " ".join(base[2 * drop :]))]
    want = similar(texts, 45)
    assert len(want) >= 16 and found(spark, texts, 45) == want


def test_copies_in_bulk_and_summary(spark):
    text = " ".join(f"word{k}" for k in range(50))
    texts = [(i, text) for i in range(40)] + [(100, text.replace("word3 ", "other ")), (101, " ".join(f"x{k}" for k in range(50)))]
    assert len(found(spark, texts, 45)) == 41 * 40 // 2
    rows = spark.createDataFrame(texts, "id bigint, text string")
    got = {r.id: (r.class_id, r.class_size, r.n_links) for r in N.duplicate_summary(*N.near_duplicate_classes(rows)).collect()}
    assert got[7] == (0, 40, 1) and got[100] == (100, 1, 1) and got[101] == (101, 1, 0)
    assert found(spark, [(1, None)], 45) == set()


def test_no_join_of_the_search_is_broadcast(spark):
    """Spark underestimates rows made in workers and lists of bits; a broadcast would send the whole table to the driver."""
    texts = [(i, " ".join(f"w{(i * 7 + k * k) % 900}" for k in range(60))) for i in range(400)]
    rows = spark.createDataFrame(texts, "id bigint, text string")
    members, links = N.near_duplicate_classes(rows)
    for out in (N.near_duplicate_pairs(members, links), N.duplicate_summary(members, links)):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "NestedLoop" not in plan


def folder_bytes(folders):
    total = 0
    for folder in folders:
        for place, _, names in os.walk(folder):
            for name in names:
                try:
                    total += os.path.getsize(os.path.join(place, name))
                except OSError:  # removed meanwhile
                    pass
    return total


def few_words_many_texts(count):
    """Texts over so few words that most combinations need all their bits, some with a few words changed."""
    r = np.random.default_rng(11)
    words = np.array([f"w{k}" for k in range(400)])
    drawn = r.integers(0, 400, (count, 60))
    changed = drawn[: count // 10].copy()
    for row in changed:
        row[r.integers(0, 60, int(r.integers(0, 16)))] = r.integers(0, 400)
    return [(i, " ".join(words[row])) for i, row in enumerate(np.concatenate([drawn, changed]))]


def test_rounds_keep_the_disk_in_proportion(spark, monkeypatch):
    """Peak of the shuffle files while many combinations are joined; they were written all at once before."""
    monkeypatch.setattr(N, "ROUND_BYTES", 48, raising=False)
    monkeypatch.setattr(N, "ROUND_LEAST", 0, raising=False)
    rows = spark.createDataFrame(few_words_many_texts(3000), "id bigint, text string").cache()
    rows.count()
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    peak, over, before = [0], threading.Event(), folder_bytes(folders)

    def watch():
        while not over.wait(0.02):
            peak[0] = max(peak[0], folder_bytes(folders))

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        found = N.near_duplicate_pairs(*N.near_duplicate_classes(rows)).count()
    finally:
        over.set()
        watcher.join()
    assert found > 100
    assert peak[0] - before < 22e6


def test_rounds_find_the_same_pairs(spark, monkeypatch):
    texts = few_words_many_texts(500)
    want = similar(texts, 45)
    asked = []
    needed = N.rounds_needed
    monkeypatch.setattr(N, "rounds_needed", lambda *a: asked.append(needed(*a)) or asked[-1])
    for least in (N.ROUND_LEAST, 0):
        monkeypatch.setattr(N, "ROUND_LEAST", least)
        assert len(want) > 20 and found(spark, texts, 45) == want
    assert asked[0] == 1 and asked[1] > 2


def test_sketches_bound_the_difference():
    r = np.random.default_rng(0)
    words = [f"w{k}" for k in range(50)]
    a, b = (" ".join(r.choice(words, size=40)) for _ in range(2))
    _, n, bits = N.occurrence_bits([a, b], 1)
    difference = collections.Counter(a.split()) - collections.Counter(b.split())
    other = collections.Counter(b.split()) - collections.Counter(a.split())
    assert len(set(bits[: n[0]]) ^ set(bits[n[0] :])) == sum(difference.values()) + sum(other.values())
    assert N.least_shared(np.array([45, 50, 51, 5]), 0.8).tolist() == [36, 40, 41, 4]
