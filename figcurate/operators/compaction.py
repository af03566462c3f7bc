"""Consolidation of many small files into few well-sized ones, without loss or duplication.

``distinct_files`` turns a listing into one row per place, ``small_files`` finds those worth merging, ``consolidation_plan``
assigns every one to exactly one container of its partition, and ``consolidate`` writes the containers.  ``SnapshotTable`` keeps
Parquet data well sized: it looks for partitions with more small files than allowed, rewrites only these by dynamic overwrite,
and commits a snapshot under an exclusive name, so that a writer that started from an older snapshot fails instead of
overwriting newer data.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from figcurate.functions import ids
from figcurate.session import shared_checkpoint
from figcurate.sources.files import Files


def distinct_files(files: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per place of a store: its smallest ``file_id`` and, if listings differ, its greatest size.

    Rows with a null or blank path name no file.  The stores are a fixed list.
    """
    listed = files.select("store_name", "file_id", "n_bytes", "stored_path")
    places = listed.join(F.broadcast(stores.select("store_name", "root_dir")), "store_name").select(
        "store_name", "file_id", "n_bytes", ids.canonical_path(F.col("stored_path"), F.col("root_dir")).alias("place")
    )
    return (
        places.where(F.col("place").isNotNull())
        .groupBy("store_name", "place")
        .agg(F.min("file_id").alias("file_id"), F.max("n_bytes").alias("n_bytes"))
    )


def root_of(stores: DataFrame, store: str) -> str:
    """The folder that relative paths of ``store`` are taken from; the stores are a fixed list."""
    roots = stores.where(F.col("store_name") == store).select("root_dir").limit(1).collect()  # one row of a fixed list
    return roots[0].root_dir if roots else "/"


def named_places(records: DataFrame, column: str, store: str, stores: DataFrame) -> DataFrame:
    """The places that ``column`` of ``records`` names in ``store`` (rows may repeat)."""
    place = ids.canonical_path(F.col(column), F.lit(root_of(stores, store)))
    return records.select(F.lit(store).alias("store_name"), place.alias("place")).where(F.col("place").isNotNull())


def small_files(files: DataFrame, stores: DataFrame, named: DataFrame) -> DataFrame:
    """Distinct files with more than 0 and fewer than ``small_below_bytes`` bytes that a record names."""
    limits = F.broadcast(stores.select("store_name", "small_below_bytes", "target_bytes"))
    return (
        distinct_files(files, stores)
        .join(limits, "store_name")
        .where((F.col("n_bytes") > 0) & (F.col("n_bytes") < F.col("small_below_bytes")))
        .join(named.distinct(), ["store_name", "place"], "left_semi")  # a place named by very many rows is one row
    )


def _folder() -> Column:
    return F.regexp_extract("place", "^(.*)/[^/]*$", 1)


def crowded_partitions(small: DataFrame, max_small: int = 8) -> DataFrame:
    """(store_name, partition, small_files, small_bytes): folders that hold more than ``max_small`` small files."""
    counted = small.groupBy("store_name", _folder().alias("partition")).agg(
        F.count("*").alias("small_files"), F.sum("n_bytes").alias("small_bytes")
    )
    return counted.where(F.col("small_files") > max_small)


#: Parts into which the files of one folder are dealt where they meet what is known of it.
SALTS = 16


def consolidation_plan(small: DataFrame, targets_per_bucket: int = 4, max_small: int = 8) -> DataFrame:
    """(store_name, file_id, partition, container_id, offset_bytes, n_bytes): each file in exactly one container.

    Crowded partitions whose small files make up half a target or more are consolidated by themselves.  The files of all others
    are too few for a well-sized file of their own; they share the partition '' of their store.  A partition is cut by a hash of
    the place into buckets of about ``targets_per_bucket`` containers each, so no folder or article makes one bucket large.
    Within a bucket files are laid end to end in order of ``file_id`` and cut into equal containers whose number is that of
    whole targets (at least one), so no container is left nearly empty.
    """
    targets = F.broadcast(small.groupBy("store_name").agg(F.first("target_bytes").alias("target")))  # the stores are a fixed list
    alone = crowded_partitions(small, max_small).join(targets, "store_name").where(F.col("small_bytes") * 2 >= F.col("target"))
    alone = alone.select("store_name", F.col("partition").alias("folder"), F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"), F.lit(True).alias("alone"))
    dealt = small.select(
        "store_name", "file_id", "place", "n_bytes", "target_bytes", _folder().alias("folder"),
        F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    placed = dealt.join(alone, ["store_name", "folder", "salt"], "left").withColumn(
        "partition", F.when(F.col("alone"), F.col("folder")).otherwise(F.lit(""))
    )
    # sums over a folder or store are folded by salt first, and meet the files by salt again
    per_salt = placed.groupBy("store_name", "partition", "salt").agg(F.sum("n_bytes").alias("n"), F.first("target_bytes").alias("target"))
    whole = Window.partitionBy("store_name", "partition")  # at most ``SALTS`` rows each
    n_buckets = F.greatest(F.lit(1), F.ceil(F.sum("n").over(whole) / (F.col("target") * targets_per_bucket)))
    buckets = per_salt.select("store_name", "partition", "salt", n_buckets.alias("buckets"))
    bucketed = placed.join(buckets, ["store_name", "partition", "salt"]).withColumn(
        "bucket", F.pmod(F.xxhash64("place", F.lit(1)), F.col("buckets"))
    )
    keys = ["store_name", "partition", "bucket"]
    start = F.sum("n_bytes").over(Window.partitionBy(*keys).orderBy("file_id")) - F.col("n_bytes")
    total = F.sum("n_bytes").over(Window.partitionBy(*keys))
    count = F.greatest(F.lit(1), F.round(total / F.col("target_bytes"))).cast("bigint")
    laid = bucketed.select(*keys, "file_id", "n_bytes", start.alias("start"), total.alias("total"), count.alias("count"))
    part = F.least(F.floor(F.col("start") * F.col("count") / F.col("total")), F.col("count") - 1).cast("bigint")
    parted = laid.withColumn("part", part)
    inside = Window.partitionBy(*keys, "part")
    name = F.when(F.col("partition") != "", F.concat(F.lit("-"), F.lower(F.hex(F.xxhash64("partition"))))).otherwise(F.lit(""))
    return parted.select(
        "store_name", "file_id", "partition",
        F.concat(F.col("store_name"), name, F.lit("-"), F.concat_ws("-", "bucket", "part")).alias("container_id"),
        (F.col("start") - F.min("start").over(inside)).alias("offset_bytes"),
        "n_bytes",
    )


def plan_faults(small: DataFrame, plan: DataFrame) -> DataFrame:
    """(store_name, files, bytes, missing, twice, gaps, off_size) by store: what a plan must keep.

    ``gaps`` are containers whose files do not lie end to end; ``off_size`` are containers of less than half or more than
    twice the target in a store that fills one at all.
    """
    wanted = small.groupBy("store_name").agg(
        F.count("*").alias("files"), F.sum("n_bytes").alias("bytes"), F.first("target_bytes").alias("target")
    )
    placed = plan.groupBy("store_name", "file_id").agg(F.count("*").alias("n")).groupBy("store_name").agg(
        F.count("*").alias("placed"), F.count_if(F.col("n") > 1).alias("twice")
    )
    order = Window.partitionBy("container_id").orderBy("offset_bytes", "file_id")
    before = F.coalesce(F.lag(F.col("offset_bytes") + F.col("n_bytes")).over(order), F.lit(0))
    lying = plan.select("store_name", "container_id", "n_bytes", (F.col("offset_bytes") != before).alias("gap"))
    containers = lying.groupBy("store_name", "container_id").agg(F.sum("n_bytes").alias("n"), F.bool_or("gap").alias("gap"))
    off = (F.col("bytes") >= F.col("target")) & ((F.col("n") * 2 < F.col("target")) | (F.col("n") > F.col("target") * 2))
    sized = containers.join(F.broadcast(wanted), "store_name").groupBy("store_name").agg(
        F.count_if("gap").alias("gaps"), F.count_if(off).alias("off_size")
    )
    joined = wanted.join(placed, "store_name", "left").join(sized, "store_name", "left")
    missing = F.col("files") - F.coalesce("placed", F.lit(0))
    return joined.select("store_name", "files", "bytes", missing.alias("missing"), "twice", "gaps", "off_size")


class Conflict(RuntimeError):
    """Another writer committed a snapshot after this one began."""


class SnapshotTable:
    """Partitioned Parquet data with snapshots.

    =======================  ==========================================================================
    data/_batch=B/...        the files of one write, by partition; written by dynamic overwrite
    _manifests/B             a table (partition, name, bytes) of the files of that write
    _manifests/state-N       the same of all files of snapshot N, written every ``FOLD`` commits
    _snapshots/N.json        commit N: its manifest, and whether it replaces its partitions or adds to them
    =======================  ==========================================================================

    A snapshot is the fold of the commits up to it.  Listings and manifests are tables that executors write and read; the driver
    sees one small JSON a commit and the names of folders, never those of files.  A commit creates the next number exclusively: if
    it exists, another writer was first, and a replacing commit succeeds only if that writer touched none of its partitions.  Old
    files stay until ``expire``.
    """

    FOLD = 32

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str]):
        self.spark, self.partition_by, self.store = spark, partition_by, Files(spark, path)

    # snapshots
    def version(self) -> int:
        return max((int(n[:-5]) for n in self.store.names("_snapshots") if n.endswith(".json")), default=0)

    def _commit_of(self, version: int) -> dict:
        return json.loads(self.store.read(f"_snapshots/{version}.json")) if version else {}

    def _manifest(self, name: str) -> DataFrame:
        return self.spark.read.schema("partition string, name string, bytes bigint").parquet(self.store.path(f"_manifests/{name}"))

    def live(self, version: int | None = None) -> DataFrame:
        """(partition, name, bytes) of the files of a snapshot."""
        version = self.version() if version is None else version
        folded = max((int(n[6:]) for n in self.store.names("_manifests") if n.startswith("state-") and int(n[6:]) <= version
                      and self.store.exists(f"_manifests/{n}/_SUCCESS")), default=0)
        events = self.spark.createDataFrame([], "partition string, name string, bytes bigint, at int, replaces boolean")
        if folded:
            events = events.unionByName(self._manifest(f"state-{folded}").withColumns({"at": F.lit(folded), "replaces": F.lit(False)}))
        for at in range(folded + 1, version + 1):  # at most ``FOLD`` and those written meanwhile
            about = self._commit_of(at)
            events = events.unionByName(self._manifest(about["manifest"]).withColumns({"at": F.lit(at), "replaces": F.lit(about["replaces"])}))
        last = events.where("replaces").groupBy("partition").agg(F.max("at").alias("since"))
        return events.join(last, "partition", "left").where(F.col("at") >= F.coalesce("since", F.lit(0))).select("partition", "name", "bytes")

    def files(self, version: int | None = None) -> dict[str, dict[str, int]]:
        """By partition the files of a snapshot with their sizes, for a look at small tables; everything else stays with ``live``."""
        out: dict[str, dict[str, int]] = {}
        for row in self.live(version).orderBy("partition", "name").collect():
            out.setdefault(row.partition, {})[row.name] = row.bytes
        return out

    def _commit(self, base: int, changed: DataFrame | dict[str, dict[str, int]], append: bool, schema: T.StructType | None = None) -> int:
        if isinstance(changed, dict):
            rows = [(part, name, size) for part, names in changed.items() for name, size in names.items()]
            changed = self.spark.createDataFrame(rows, "partition string, name string, bytes bigint")
        manifest = uuid.uuid4().hex
        changed.write.parquet(self.store.path(f"_manifests/{manifest}"))
        own = self._manifest(manifest).select("partition").distinct()
        checked = base
        while True:
            now = self.version()
            for other in range(checked + 1, now + 1) if not append else ():
                clash = own.join(self._manifest(self._commit_of(other)["manifest"]), "partition", "left_semi").limit(3).collect()
                if clash:
                    raise Conflict(f"partitions changed since snapshot {base}: {[r.partition for r in clash]}")
            checked = now
            known = self._schema(now)
            fields = {f.name: f for s in (known, schema) if s is not None for f in s.fields}
            about = {"manifest": manifest, "replaces": not append, "schema": T.StructType(list(fields.values())).jsonValue()}
            if self.store.create(f"_snapshots/{now + 1}.json", json.dumps(about)):
                if (now + 1) % self.FOLD == 0:
                    self.live(now + 1).write.mode("overwrite").parquet(self.store.path(f"_manifests/state-{now + 1}"))
                return now + 1

    def _schema(self, version: int) -> T.StructType | None:
        found = self._commit_of(version).get("schema")
        return T.StructType.fromJson(found) if found else None

    def _write(self, df: DataFrame) -> DataFrame:
        """Write new files beside the old ones, in a batch of their own; returns (partition, name, bytes) of them."""
        batch = uuid.uuid4().hex
        overwrite_partitions(df.withColumn("_batch", F.lit(batch)), self.store.path("data"), ["_batch", *self.partition_by])
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
        name = F.regexp_extract("path", f"(data/_batch={batch}/.*)$", 1)
        found = listed.load(self.store.path(f"data/_batch={batch}")).select(name.alias("name"), F.col("length").alias("bytes"))
        return found.select(_partition_of(F.col("name")).alias("partition"), "name", "bytes")

    # operations
    def append(self, df: DataFrame) -> int:
        if df.isEmpty():
            return self.version()
        return self._commit(self.version(), self._write(df), append=True, schema=df.schema)

    def read(self, version: int | None = None, partitions: list[str] | None = None) -> DataFrame:
        """The rows of a snapshot, or of some of its partitions, in one scan."""
        return self._scan(self.version() if version is None else version, partitions).drop("_part")

    def _scan(self, version: int, partitions: list[str] | None = None) -> DataFrame:
        live = self.live(version)
        if partitions is not None:
            live = live.where(F.col("partition").isin(partitions))
        folders = [r.folder for r in live.select(F.regexp_extract("name", "^(.*)/[^/]*$", 1).alias("folder")).distinct().collect()]
        if not folders:
            raise FileNotFoundError(f"no data in {self.store.root}")
        schema = T.StructType([*self._schema(version).fields, T.StructField("_batch", T.StringType())])
        rows = self.spark.read.schema(schema).option("basePath", self.store.path("data")).parquet(*(self.store.path(f) for f in sorted(folders)))
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        return rows.select(*self._schema(version).names, _partition_of(F.regexp_extract(path, "(data/_batch=.*)$", 1)).alias("_part"))

    def crowded(self, small_below: int, max_small: int, version: int | None = None) -> DataFrame:
        """(partition, files, bytes) of partitions with more than ``max_small`` files below ``small_below`` bytes."""
        counted = self.live(version).groupBy("partition").agg(
            F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.count_if(F.col("bytes") < small_below).alias("small")
        )
        return counted.where(F.col("small") > max_small).select("partition", "files", "bytes")

    def compact(self, target_bytes: int, small_below: int | None = None, max_small: int = 1) -> dict[str, int]:
        """Rewrite the crowded partitions only, all in one job; returns the number of files now in each.

        A partition gets as many files as its size asks for.  Rows are dealt to them by a hash of the whole row, so a task that
        runs again deals them alike.
        """
        base = self.version()
        wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("bigint")
        crowded = self.crowded(target_bytes // 2 if small_below is None else small_below, max_small, base)
        counts = crowded.select(F.col("partition").alias("_part"), wanted.alias("_files")).collect()  # one row a crowded partition
        if not counts:
            return {}
        parts = [r._part for r in counts]
        rows = self._scan(base, parts)
        schema = self._schema(base)
        files = self.spark.createDataFrame([tuple(r) for r in counts], "_part string, _files bigint")
        salt = F.pmod(F.xxhash64(*schema.names), F.col("_files"))
        spread = rows.join(F.broadcast(files), "_part").withColumn("_salt", salt)
        spread = spread.repartition(sum(r._files for r in counts), "_part", "_salt")
        changed = shared_checkpoint(self._write(spread.drop("_part", "_files", "_salt")))
        done = {r.partition: r["count"] for r in changed.groupBy("partition").count().collect()}
        if set(done) != set(parts):
            raise Conflict(f"wrote {sorted(set(done) ^ set(parts))[:3]} besides or instead of what was read")
        self._commit(base, changed, append=False, schema=schema)
        return done

    def expire(self, keep: int = 1) -> int:
        """Delete the files of commits that none of the last ``keep`` snapshots holds any more; returns how many.

        Only files on record are deleted, so a write that has not been committed yet is left alone.
        """
        last = self.version()
        used = self.live(last)
        for version in range(max(1, last - keep + 1), last):
            used = used.unionByName(self.live(version))
        known = None
        for version in range(1, last + 1):
            rows = self._manifest(self._commit_of(version)["manifest"])
            known = rows if known is None else known.unionByName(rows)
        if known is None:
            return 0
        folder = F.regexp_extract("name", "^(.*)/[^/]*$", 1)
        gone = known.join(used.select("name").distinct(), "name", "left_anti").groupBy(folder.alias("folder")).agg(F.count("*").alias("n")).collect()
        deleted = 0
        for row in gone:
            if self.store.exists(row.folder):
                self.store.delete(row.folder, recursive=True)
                deleted += row.n
        return deleted


def _partition_of(name: Column) -> Column:
    """The partition folders in the name of a file, below its batch."""
    return F.regexp_extract(name, "^data/_batch=[^/]+/(?:(.*)/)?[^/]+$", 1)


def consolidate(plan: DataFrame, places: DataFrame, root: str, table: SnapshotTable) -> int:
    """Put the content of small files into the containers of ``plan``: one file each of ``table``, partitioned by container.

    ``places`` holds (store_name, file_id, place) of the files, ``root`` the folder they lie under.  Rows of the table are
    (file_id, place, offset_bytes, content, store_name, container_id).  A file that is gone is left out by the join and can
    be told from the plan.  Returns the snapshot.
    """
    spark = plan.sparkSession
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    content = found.select(F.regexp_replace("path", "^[a-z0-9]+:/+", "/").alias("place"), "content")
    rows = plan.join(places.select("store_name", "file_id", "place"), ["store_name", "file_id"]).join(content, "place")
    kept = rows.select("file_id", "place", "offset_bytes", "content", "store_name", "container_id")
    dealt = kept.repartition("store_name", "container_id").sortWithinPartitions("store_name", "container_id", "offset_bytes")
    return table.append(dealt)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Dynamic overwrite: replace only the partitions that ``df`` holds."""
    writer = df.write.option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.mode("overwrite").partitionBy(*partition_by).parquet(path)
