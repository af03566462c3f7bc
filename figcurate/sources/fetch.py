"""Fetching files in tasks: resumable downloads through a pluggable opener, failures as rows."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import IO
from urllib.error import HTTPError
from urllib.parse import urlsplit
from urllib.request import Request, urlopen

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark.sql import DataFrame, SparkSession

from figcurate.sources.files import on_any_files
from figcurate.sources.images import digests_match

#: An opener takes an address and a start offset; it returns the offset at which its stream really starts, and the stream.
Opener = Callable[[str, int], tuple[int, IO[bytes]]]


def http_opener(url: str, start: int) -> tuple[int, IO[bytes]]:
    request = Request(url, headers={"Range": f"bytes={start}-"} if start else {})
    response = urlopen(request, timeout=120)
    return (start if response.status == 206 else 0), response


def download(url: str, target: str, opener: Opener = http_opener, overwrite: bool = False, md5: str = "", chunk: int = 1 << 20) -> tuple[str, str]:
    """Fetch ``url`` to ``target`` by way of a ``.part`` file that a later call continues; returns (how, md5).

    An existing target with the expected digest is reused.  A server that ignores the range starts over; one that has nothing
    beyond the partial file means the file is whole.
    """
    files, own = on_any_files(target)

    def size(path: str) -> int | None:
        info = files.get_file_info(path)
        return info.size if info.type == FileType.File else None

    if size(own) is not None and not overwrite:
        found = file_md5(target)
        if digests_match(found, md5):
            return "reused", found
    if "/" in own.strip("/"):
        files.create_dir(own.rpartition("/")[0], recursive=True)
    part = own + ".part"
    if overwrite and size(part) is not None:
        files.delete_file(part)
    start = size(part) or 0
    try:
        offset, stream = opener(url, start)
        with stream, (files.open_append_stream if offset else files.open_output_stream)(part, compression=None) as out:
            while block := stream.read(chunk):
                out.write(block)
    except HTTPError as e:
        if e.code != 416 or not start:
            raise
    found = file_md5(target + ".part")
    if not digests_match(found, md5):
        files.delete_file(part)
        raise ValueError(f"digest {found} instead of {md5}")
    files.move(part, own)
    return "downloaded", found


def file_md5(path: str, chunk: int = 1 << 20) -> str:
    value = hashlib.md5(usedforsecurity=False)
    files, own = on_any_files(path)
    with files.open_input_stream(own, compression=None) as f:
        while block := f.read(chunk):
            value.update(block)
    return value.hexdigest()


def fetched(wanted: DataFrame, root: str, opener: Opener = http_opener) -> DataFrame:
    """(url, target, status, md5, error) for rows of (url, target, expected_md5); an exception is a row, not a failed job.

    Repartition ``wanted`` to choose how many downloads run at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, target, md5 in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                try:
                    how, found = download(url, f"{root.rstrip('/')}/{target}", opener, md5=md5 or "")
                    rows.append((url, target, how, found, ""))
                except Exception as e:
                    rows.append((url, target, "failed", None, f"{type(e).__name__}: {e}"))
            columns = [pa.array([r[k] for r in rows], type=pa.string()) for k in range(5)]
            yield pa.RecordBatch.from_arrays(columns, names=["url", "target", "status", "md5", "error"])

    return wanted.select("url", "target", "expected_md5").mapInArrow(
        run, "url string, target string, status string, md5 string, error string"
    )


def bulk_pair(spark: SparkSession, archive_url: str, list_url: str, folder: str, opener: Opener = http_opener) -> dict[str, str]:
    """Fetch an archive and its file list under the last names in their addresses; (url -> path).

    ValueError if an address ends in no name, before anything is fetched; RuntimeError if a download fails.
    """
    names = {url: urlsplit(url).path.rpartition("/")[2] for url in (archive_url, list_url)}
    if not all(names.values()):
        raise ValueError(f"no file name at the end of {next(u for u, n in names.items() if not n)}")
    wanted = spark.createDataFrame([(u, n, None) for u, n in names.items()], "url string, target string, expected_md5 string").repartition(2)
    for row in fetched(wanted, folder, opener).collect():  # two rows
        if row.error:
            raise RuntimeError(f"{row.url}: {row.error}")
    return {u: f"{folder.rstrip('/')}/{n}" for u, n in names.items()}
