"""Order, nesting and counting of the panels of a figure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from figcurate.session import shared_checkpoint

Y_THRESHOLD = 0.05


def reading_order(
    boxes: DataFrame, parent: list[str], index: str = "detector_index", x: str = "x1", y: str = "y1",
    width: str = "image_width", height: str = "image_height", threshold: float = Y_THRESHOLD,
) -> DataFrame:
    """``boxes`` with ``panel_order`` counted from 0 within each parent: rows from top to bottom, each from left to right.

    Boxes sorted by their upper edge chain into a row as long as each lies at most ``threshold`` (of the image height, at
    least 1) below the one before; equal places keep the order of ``index``.  Both windows share one partitioning.
    """
    across, down = (
        F.col(c).cast("double") / F.greatest(F.coalesce(F.col(size).cast("double"), F.lit(1.0)), F.lit(1.0))
        for c, size in ((x, width), (y, height))
    )
    placed = boxes.withColumns({"_x": across, "_y": down})
    by_y = Window.partitionBy(*parent).orderBy("_y", index)
    gap = F.col("_y") - F.lag("_y").over(by_y)
    rows = placed.withColumn("_break", F.when(F.abs(gap) > threshold, 1).otherwise(0)).withColumn(
        "_row", F.sum("_break").over(by_y.rowsBetween(Window.unboundedPreceding, 0))
    )
    in_row = Window.partitionBy(*parent).orderBy("_row", "_x", "_y", index)
    return rows.withColumn("panel_order", (F.row_number().over(in_row) - 1).cast("bigint")).drop("_x", "_y", "_break", "_row")


def normalised_box(x: Column, size: Column) -> Column:
    """A coordinate as a share of the image side, which counts as 1 where it is missing or smaller."""
    return x.cast("double") / F.greatest(F.coalesce(size.cast("double"), F.lit(1.0)), F.lit(1.0))


def panel_counts(panels: DataFrame, parent: list[str], ready: Column) -> DataFrame:
    """Per parent: panels, panels that are ready, and what follows from it."""
    n, ok = F.count("*"), F.count_if(F.coalesce(ready, F.lit(False)))
    counted = panels.groupBy(*parent).agg(n.alias("panel_count"), ok.alias("ready_count"))
    status = F.when(F.col("panel_count") == F.col("ready_count"), F.lit("separated")).otherwise(F.lit("partial_crop_failure"))
    return counted.withColumn("separation_status", status)


def separation_counters(panels: DataFrame, parent: list[str], ready: Column) -> DataFrame:
    """One row: parents, those whose panels are all ready, those with a panel that is not, panels, and panels that are ready."""
    counted = panel_counts(panels, parent, ready)
    return counted.agg(
        F.count("*").alias("parents"), F.count_if(F.col("separation_status") == "separated").alias("separated"),
        F.count_if(F.col("separation_status") != "separated").alias("failed"), F.coalesce(F.sum("panel_count"), F.lit(0)).alias("panels"),
        F.coalesce(F.sum("ready_count"), F.lit(0)).alias("ready_panels"),
    )


def with_empty_parents(parents: DataFrame, counts: DataFrame, parent: list[str]) -> DataFrame:
    """Counts of every parent; those without any panel have zero."""
    return parents.join(counts, parent, "left").withColumns(
        {
            "panel_count": F.coalesce("panel_count", F.lit(0)),
            "ready_count": F.coalesce("ready_count", F.lit(0)),
            "separation_status": F.coalesce("separation_status", F.lit("no_panels_detected")),
        }
    )


def nested(panels: DataFrame, parent: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per parent with its panels as an array in order; the number of panels of one figure is bounded by the image."""
    item = F.struct(*order, *(c for c in columns if c not in order))
    return panels.groupBy(*parent).agg(F.array_sort(F.collect_list(item)).alias("panels"))


def contiguity(panels: DataFrame, parent: list[str], index: str) -> DataFrame:
    """Per parent whether its indices are 0, 1, 2, ... without gap or repetition; a null index breaks it."""
    i = F.col(index)
    whole = (
        (F.min(i) == 0) & (F.max(i) == F.count("*") - 1) & (F.countDistinct(i) == F.count("*")) & (F.count(i) == F.count("*"))
    )
    return panels.groupBy(*parent).agg(F.count("*").alias("panel_count"), F.coalesce(whole, F.lit(False)).alias("contiguous"))


def numbered_chunks(df: DataFrame, key: str, size: int, name: str = "shard") -> DataFrame:
    """``df`` with the number of its chunk of ``size`` rows in the order of the unique ``key``.

    Places are counted in two steps, per range partition and within it, so no task sorts everything.  The partitioned rows are
    written down once, as both steps must see the same partitions.
    """
    ranged = df.repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id())
    ranged = shared_checkpoint(ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(key))))
    per_part = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    before = per_part.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_at") - 1 + F.col("_before")
    return ranged.join(F.broadcast(before), "_part").withColumn(name, F.floor(place / size).cast("bigint")).drop("_part", "_at", "_before")


def packed_batches(requests: DataFrame, group: list[str], images: str, place: str, max_requests: int, max_images: int | None) -> DataFrame:
    """``requests`` with ``batch`` counted from 0 within each group.

    Requests are taken by number of images, then place.  A batch ends when it holds ``max_requests`` or the next request would
    take it beyond ``max_images``; a request larger than that has a batch of its own.  The fold needs a group in one row, so
    groups are bounded (shards); it runs inside the JVM.
    """
    if max_requests < 1 or (max_images is not None and max_images < 1):
        raise ValueError("limits must be positive")
    item = F.struct(F.col(images).cast("bigint").alias("n"), F.col(place).cast("bigint").alias("p"))
    arrays = requests.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias("items"))
    begin = F.expr(
        "named_struct('batch', 0L, 'held', 0L, 'images', 0L, 'out', cast(array() as array<struct<p: bigint, batch: bigint>>))"
    )

    def step(acc: Column, x: Column) -> Column:
        over = acc["held"] >= max_requests
        if max_images is not None:
            over = over | ((acc["held"] > 0) & (acc["images"] + x["n"] > max_images))
        batch = acc["batch"] + F.when(over, 1).otherwise(0).cast("bigint")
        return F.struct(
            batch.alias("batch"),
            F.when(over, F.lit(1)).otherwise(acc["held"] + 1).cast("bigint").alias("held"),
            F.when(over, x["n"]).otherwise(acc["images"] + x["n"]).alias("images"),
            F.array_append(acc["out"], F.struct(x["p"].alias("p"), batch.alias("batch"))).alias("out"),
        )

    planned = arrays.select(*group, F.inline(F.aggregate("items", begin, step, lambda acc: acc["out"])))
    return requests.join(planned.withColumnRenamed("p", place), [*group, place])
