"""``python -m figcurate``: the parts that need no model, over files."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from figcurate.operators.compaction import SnapshotTable
from figcurate.plans import pipelines
from figcurate.session import local_session
from figcurate.sources import articles, jats, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="figcurate", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    one = sub.add_parser("extract-folder", help="figures of a folder of article XML")
    one.add_argument("xml_dir")
    one.add_argument("output")
    one.add_argument("--metadata-dir")
    two = sub.add_parser("extract-archive", help="figures of article archives with their file list")
    two.add_argument("archive")
    two.add_argument("file_list")
    two.add_argument("output")
    for p in (one, two):
        p.add_argument("--licenses", help="comma-separated allow list; the open licences if not given")
        p.add_argument("--max-articles", type=int)
        p.add_argument("--keep-uncaptioned", action="store_true")
    three = sub.add_parser("query", help="a registered query over a folder of tables")
    three.add_argument("name")
    three.add_argument("tables")
    three.add_argument("output")
    four = sub.add_parser("compact", help="consolidate the crowded partitions of a snapshot table")
    four.add_argument("table")
    four.add_argument("--partition-by", nargs="+", required=True)
    four.add_argument("--target-bytes", type=int, default=128 << 20)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = local_session()
    if args.command == "query":
        import importlib

        sinks.write_table(importlib.import_module("__spark_entry__").queries()[args.name](spark, args.tables), args.output)
        return 0
    if args.command == "compact":
        print(SnapshotTable(spark, args.table, args.partition_by).compact(args.target_bytes))
        return 0
    if args.command == "extract-archive":
        files = articles.xml_archives(spark, args.archive, args.max_articles)
        known = articles.file_list(spark, args.file_list)
        figures = pipelines.extract(files, known, "pmcid", args.licenses, not args.keep_uncaptioned)
    else:
        files = articles.xml_folder(spark, args.xml_dir, args.max_articles)
        if args.metadata_dir:
            known = articles.sidecars(spark, args.metadata_dir).select("stem", "metadata.*", "retracted")
            figures = pipelines.extract(files, known, "stem", args.licenses, not args.keep_uncaptioned)
        else:
            figures = jats.parse_articles(files, not args.keep_uncaptioned)
    sinks.write_table(figures, args.output)
    written = spark.read.parquet(args.output)
    print(sinks.write_summary(written.agg(F.count("*").alias("figures"), F.countDistinct("pmcid").alias("articles")), args.output.rstrip("/") + "_summary.json"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
