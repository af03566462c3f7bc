"""Splits that keep related records together: connected components by a frontier search from many seeds at once.

Records that share a key value (here an article or a parent image) are connected.  Values with one neighbour connect nothing
and never enter the search; a value shared by many articles adds a star of edges, not all pairs.

One round of the search hashes all nodes and takes as seeds those whose hash is smaller than all their neighbours', which
leaves a seed in every component.  All seeds are expanded at once: per level, the frontier is joined with the adjacency lists,
hash-partitioned by node, and every node takes the smallest seed that reaches it first.  Edges between nodes of different seeds
form a smaller graph of colliding seeds, which the next round solves in the same way, until no edge is left; labels are then
carried back.  Each round at least halves the graph.  Intermediate tables are cut off by ``checkpoint()`` in the shared folder;
nothing but row counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from figcurate.functions import ids
from figcurate.session import shared_checkpoint


def links(records: DataFrame, node: Column, shared: Column) -> DataFrame:
    """Distinct (node, shared) with both known."""
    return (
        records.select(node.alias("node"), shared.alias("shared"))
        .where(F.col("node").isNotNull() & F.col("shared").isNotNull())
        .distinct()
    )


def star_edges(pairs: DataFrame) -> DataFrame:
    """(a, b), a < b: each node of a shared value with the smallest node of that value."""
    hubs = pairs.groupBy("shared").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where(F.col("n") > 1)
    return (
        pairs.join(hubs, "shared")
        .where(F.col("node") != F.col("hub"))
        .select(F.col("hub").alias("a"), F.col("node").alias("b"))
        .distinct()
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    swapped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(swapped).where(F.col("a") != F.col("b")).distinct()


def _search(edges: DataFrame, round_no: int) -> DataFrame:
    """(node, label): each node of ``edges`` (both ways) with the seed that reached it."""
    rank = F.struct(F.xxhash64("a", F.lit(round_no)), F.col("a"))
    other = F.struct(F.xxhash64("b", F.lit(round_no)), F.col("b"))
    nodes = edges.groupBy("a").agg(F.min(other).alias("least"))
    seeds = nodes.where(rank < F.col("least")).select(F.col("a").alias("node"), F.col("a").alias("label"))
    frontier = shared_checkpoint(seeds)
    reached = frontier  # grows by union of what was written down
    while True:
        ahead = (
            frontier.join(edges, frontier.node == edges.a)
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("label"))
            .join(reached.select("node"), "node", "left_anti")
        )
        frontier = shared_checkpoint(ahead)
        if frontier.isEmpty():
            return reached
        reached = reached.unionByName(frontier)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the component is named by one of its nodes; nodes without an edge are not listed."""
    graph = shared_checkpoint(_both_ways(edges))
    rounds: list[DataFrame] = []
    while not graph.isEmpty():
        labels = _search(graph, len(rounds))
        rounds.append(labels)
        near, far = labels.select(F.col("node").alias("a"), F.col("label").alias("la")), labels.select(
            F.col("node").alias("b"), F.col("label").alias("lb")
        )
        collisions = graph.join(near, "a").join(far, "b").where(F.col("la") != F.col("lb"))
        graph = shared_checkpoint(
            _both_ways(collisions.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
        )
    if not rounds:
        kind = edges.schema["a"].dataType.simpleString()
        return edges.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    result = rounds[0].select("node", F.col("label").alias("component"))
    for labels in rounds[1:]:
        step = labels.select(F.col("node").alias("component"), F.col("label").alias("merged"))
        result = result.join(step, "component", "left").select("node", F.coalesce("merged", "component").alias("component"))
    return shared_checkpoint(result)


def article_components(records: DataFrame) -> DataFrame:
    """(node, component) of the articles that share a parent image with another article."""
    pairs = links(records, ids.canonical_pmcid(F.col("pmcid")), ids.canonical_image_id(F.col("parent_image_id")))
    return connected_components(star_edges(pairs))


def connected_pairs(components: DataFrame) -> DataFrame:
    """(pmcid_a, pmcid_b), a < b: the pairs of one component, which the result by definition lists in full."""
    left = components.select("component", F.col("node").alias("pmcid_a"))
    right = components.select("component", F.col("node").alias("pmcid_b"))
    return left.join(right, "component").where(F.col("pmcid_a") < F.col("pmcid_b")).select("pmcid_a", "pmcid_b")


#: Parts into which the records of one article or group are dealt where they are joined, as one may hold a third of them.
SALTS = 32


def _salt() -> Column:
    return F.pmod(F.xxhash64("record_id"), F.lit(SALTS)).cast("int")


def _salts() -> Column:
    return F.array(*map(F.lit, range(SALTS)))


def record_groups(records: DataFrame) -> DataFrame:
    """(record_id, group_id): records connected by a chain of shared articles and parent images have the same group.

    A record without an article takes the group of its parent image, if an article has that image, else the image itself is
    its group; a record with neither is a group of its own.
    """
    article = ids.canonical_pmcid(F.col("pmcid"))
    image = ids.canonical_image_id(F.col("parent_image_id"))
    rows = records.select("record_id", article.alias("article"), image.alias("image"))
    owners = rows.where(F.col("article").isNotNull() & F.col("image").isNotNull()).groupBy("image").agg(
        F.min("article").alias("owner")
    )
    orphans = rows.where(F.col("article").isNull() & F.col("image").isNotNull()).join(owners, "image", "left")
    none = F.concat(F.lit("record:"), F.col("record_id").cast("string"))
    anchored = (
        rows.where(F.col("article").isNotNull())
        .select("record_id", F.col("article").alias("anchor"))
        .unionByName(
            orphans.select("record_id", F.coalesce("owner", F.concat(F.lit("image:"), "image")).alias("anchor"))
        )
        .unionByName(rows.where(F.col("article").isNull() & F.col("image").isNull()).select("record_id", none.alias("anchor")))
    )
    components = article_components(records).select(F.col("node").alias("anchor"), "component", F.explode(_salts()).alias("salt"))
    salted = anchored.withColumn("salt", _salt())
    return salted.join(components, ["anchor", "salt"], "left").select("record_id", F.coalesce("component", "anchor").alias("group_id"))


def assign_splits(groups: DataFrame, targets: DataFrame, seed: int = 0, large: float = 0.002, buckets: int = 256) -> DataFrame:
    """(record_id, group_id, split_name): whole groups in the given shares of records.

    Groups that hold more than ``large`` of all records, of which there are at most 1 / ``large``, go one by one, the largest
    first, to the split that is furthest below its share.  All others follow in the order of their hash: a group belongs to
    the split whose share of the remaining records holds the middle of the group.  Running totals are taken in two steps, over
    ``buckets`` hash ranges and within each, so that no task sees all groups.  Shares are taken relative to their sum.
    """
    sizes = shared_checkpoint(groups.groupBy("group_id").agg(F.count("*").alias("n")))
    names = [(r.split_name, float(r.share)) for r in targets.orderBy("split_name").collect()]  # a fixed list
    total_share = sum(s for _, s in names) or 1.0
    n_all = sizes.agg(F.sum("n")).first()[0] or 0
    big = sizes.where(F.col("n") > n_all * large).orderBy(F.desc("n"), "group_id").collect()  # at most 1 / large rows
    room = {name: share / total_share * n_all for name, share in names}
    placed = []
    for row in big:
        name = max(names, key=lambda x: (room[x[0]], x[0]))[0]
        room[name] -= row.n
        placed.append((row.group_id, name))
    rest = sum(max(v, 0.0) for v in room.values()) or 1.0
    bounds, at = [], 0.0
    for name, _ in names:
        at += max(room[name], 0.0) / rest
        bounds.append((name, at))
    large_ones = sizes.sparkSession.createDataFrame(placed, "group_id string, split_name string")
    small = sizes.where(F.col("n") <= n_all * large).withColumn("h", F.xxhash64("group_id", F.lit(seed)))
    small = small.withColumn("bucket", F.shiftrightunsigned("h", 64 - (buckets - 1).bit_length()))
    per_bucket = small.groupBy("bucket").agg(F.sum("n").alias("m"))
    before = per_bucket.select(
        "bucket", (F.sum("m").over(Window.orderBy("bucket")) - F.col("m")).alias("before")
    )  # at most ``buckets`` rows
    whole = n_all - sum(r.n for r in big)
    inside = F.sum("n").over(Window.partitionBy("bucket").orderBy("h", "group_id")) - F.col("n") / 2
    middle = (F.col("before") + inside) / F.lit(float(whole or 1))
    name = F.lit(bounds[-1][0])
    for bound_name, bound in reversed(bounds[:-1]):
        name = F.when(middle < bound, F.lit(bound_name)).otherwise(name)
    chosen = small.join(F.broadcast(before), "bucket").select("group_id", name.alias("split_name"), F.lit(0).alias("salt"))
    chosen = chosen.unionByName(large_ones.withColumn("salt", F.explode(_salts())))
    is_large = F.col("group_id").isin([g for g, _ in placed]) if placed else F.lit(False)
    salted = groups.select("record_id", "group_id", F.when(is_large, _salt()).otherwise(0).alias("salt"))
    return salted.join(chosen, ["group_id", "salt"]).select("record_id", "group_id", "split_name")


def split_faults(records: DataFrame, splits: DataFrame, targets: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """One row on what splits must keep: (records, unassigned, torn_articles, torn_images, splits, splits_near_target).

    An article or image is torn if its records lie in more than one split; a split is near its target if its share of records
    differs from the wanted one by no more than ``tolerance``.
    """
    rows = records.select(
        "record_id", ids.canonical_pmcid(F.col("pmcid")).alias("article"), ids.canonical_image_id(F.col("parent_image_id")).alias("image")
    )
    joined = shared_checkpoint(rows.join(splits.select("record_id", "split_name"), "record_id", "left"))

    def torn(column: str) -> Column:
        ends = joined.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("split_name").alias("a"), F.max("split_name").alias("b"))
        return ends.where("a <> b").select(F.count("*")).scalar()

    total = joined.agg(F.count("*")).scalar()
    sums = targets.agg(F.sum("share")).scalar()
    by_split = targets.join(joined.groupBy("split_name").agg(F.count("*").alias("n")), "split_name", "left")
    near = F.abs(F.coalesce("n", F.lit(0)) / total - F.col("share") / sums) <= tolerance
    counted = by_split.agg(F.count("*").alias("splits"), F.count_if(near).alias("splits_near_target"))
    unassigned = joined.where(F.col("split_name").isNull()).select(F.count("*")).scalar()
    return counted.select(
        total.alias("records"), unassigned.alias("unassigned"), torn("article").alias("torn_articles"), torn("image").alias("torn_images"),
        "splits", "splits_near_target",
    )
