"""Image files: listing, digests, and size and kind read from the first bytes without an image library."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figcurate.functions.text import is_raster


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, md5, content) of the raster images below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(is_raster(F.col("path"))).select("path", "length", F.md5("content").alias("md5"), "content")


def read_header(data: bytes) -> tuple[int, int, str, str]:
    """(width, height, format, mode); raises ValueError for what is no image or has no area."""
    found = _png(data) or _gif(data) or _bmp(data) or _jpeg(data) or _tiff(data) or _webp(data)
    if not found:
        raise ValueError("unknown image format")
    if found[0] < 1 or found[1] < 1:
        raise ValueError("image without area")
    return found


def _png(data: bytes) -> tuple[int, int, str, str] | None:
    if data[:8] != b"\x89PNG\r\n\x1a\n" or len(data) < 26:
        return None
    width, height, _, colour = struct.unpack(">IIBB", data[16:26])
    return width, height, "PNG", {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}.get(colour, "?")


def _gif(data: bytes) -> tuple[int, int, str, str] | None:
    return (*struct.unpack("<HH", data[6:10]), "GIF", "P") if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10 else None


def _bmp(data: bytes) -> tuple[int, int, str, str] | None:
    if data[:2] != b"BM" or len(data) < 30:
        return None
    width, height, _, bits = struct.unpack("<iiHH", data[18:30])
    return width, abs(height), "BMP", "P" if bits <= 8 else "RGB"


def _jpeg(data: bytes) -> tuple[int, int, str, str] | None:
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 < len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
        elif kind == 0x01 or 0xD0 <= kind <= 0xD8:
            at += 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width, parts = struct.unpack(">HHB", data[at + 5 : at + 10])
            return width, height, "JPEG", {1: "L", 3: "RGB", 4: "CMYK"}.get(parts, "?")
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


def _tiff(data: bytes) -> tuple[int, int, str, str] | None:
    """The tags of the first image: width, height, bits, photometric kind and samples of a pixel."""
    order = {b"II*\0": "<", b"MM\0*": ">"}.get(data[:4])
    if order is None:
        return None
    (at,) = struct.unpack_from(f"{order}I", data, 4)
    (count,) = struct.unpack_from(f"{order}H", data, at)
    tags = {}
    for k in range(count):
        tag, kind, _ = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * k)
        if kind in (3, 4):
            (tags[tag],) = struct.unpack_from(f"{order}{'H' if kind == 3 else 'I'}", data, at + 10 + 12 * k)
    mode = {3: "P", 5: "CMYK"}.get(tags.get(262), {1: "L", 3: "RGB", 4: "RGBA"}.get(tags.get(277, 1), "?"))
    return tags.get(256, 0), tags.get(257, 0), "TIFF", mode


def _webp(data: bytes) -> tuple[int, int, str, str] | None:
    """Sizes of the extended, lossless and lossy forms, which count from one less in the first two."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP" or len(data) < 30:
        return None
    form = data[12:16]
    if form == b"VP8X":
        width, height = (int.from_bytes(data[k : k + 3], "little") + 1 for k in (24, 27))
        return width, height, "WEBP", "RGBA" if data[20] & 0x10 else "RGB"
    if form == b"VP8L":
        bits = int.from_bytes(data[21:25], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1, "WEBP", "RGBA" if bits >> 28 & 1 else "RGB"
    width, height = struct.unpack_from("<HH", data, 26)
    return width & 0x3FFF, height & 0x3FFF, "WEBP", "RGB"


def inspected(files: DataFrame) -> DataFrame:
    """(path, width, height, format, mode, error) of (path, content) files; an unreadable file has an error."""
    schema = "path string, width int, height int, format string, mode string, error string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows.append((path, *read_header(content or b""), ""))
                except (ValueError, struct.error) as e:
                    rows.append((path, None, None, None, None, str(e)))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            columns = [pa.array([r[k] for r in rows], type=t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "width", "height", "format", "mode", "error"])

    return files.select("path", "content").mapInArrow(run, schema)


def digests_match(actual: str | None, expected: str | None) -> bool:
    """Whether a digest fits; without an expected one everything does."""
    return not expected or (actual or "").lower() == expected.lower()
