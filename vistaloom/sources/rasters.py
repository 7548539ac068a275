"""Depth and label rasters: a reader of PNG files in NumPy, and scans of frames with their rasters."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Raster units per metre by source.
DEPTH_SCALE = {"scannet": 1000.0, "matterport": 4000.0}


def read_png(data: bytes) -> np.ndarray:
    """A grey or colour PNG of 8 or 16 bits without interlace as (height, width[, channels])."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, body, head = 8, [], b""
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = part
        elif kind == b"IDAT":
            body.append(part)
        at += 12 + n
    width, height, bits, colour, _, _, interlace = struct.unpack(">IIBBBBB", head)
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if channels is None or bits not in (8, 16) or interlace:
        raise ValueError("this kind of PNG is not read")
    step, line = channels * bits // 8, width * channels * bits // 8
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, line + 1)
    flat = unfiltered(raw[:, 0], raw[:, 1:].reshape(height, width, step)).reshape(height, line)
    values = flat.reshape(height, -1) if bits == 8 else flat.reshape(height, -1, 2).astype(np.uint16) @ np.array([256, 1], np.uint16)
    return values if channels == 1 else values.reshape(height, width, channels)


def unfiltered(kinds: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A PNG's bytes (row, pixel, byte of pixel) without its rows' filters.

    Rows that look at no other byte, to the left only or up only are done whole; where there are others, all pixels of one
    diagonal are done together, as each needs only its left, upper and upper left neighbours.
    """
    height, width, step = x.shape
    out = np.zeros((height + 1, width + 1, step), np.int32)  # a row and a pixel of zeros before the first
    if (kinds < 3).all():
        for y in range(height):
            out[y + 1, 1:] = x[y] if kinds[y] == 0 else np.cumsum(x[y].astype(np.int32), axis=0) & 255 if kinds[y] == 1 else (x[y] + out[y, 1:]) & 255
        return out[1:, 1:].astype(np.uint8)
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        c = d - y
        left, above, corner = out[y + 1, c], out[y, c + 1], out[y, c]
        p = left + above - corner
        pa, pb, pc = np.abs(p - left), np.abs(p - above), np.abs(p - corner)
        paeth = np.where((pa <= pb) & (pa <= pc), left, np.where(pb <= pc, above, corner))
        kind = kinds[y][:, None]
        guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, above, (left + above) // 2, paeth], 0)
        out[y + 1, c + 1] = (x[y, c] + guess) & 255
    return out[1:, 1:].astype(np.uint8)


def write_png(values: np.ndarray) -> bytes:
    """A grey PNG of 8 or 16 bits."""
    bits = 16 if values.dtype == np.uint16 else 8
    raw = values.astype(">u2" if bits == 16 else "u1")
    lines = b"".join(b"\x00" + r.tobytes() for r in raw)
    chunk = lambda kind, part: struct.pack(">I", len(part)) + kind + part + struct.pack(">I", zlib.crc32(kind + part))
    head = struct.pack(">IIBBBBB", values.shape[1], values.shape[0], bits, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def depth_rasters(spark: SparkSession, root: str, source: str) -> DataFrame:
    """(scene_id, frame_id, width, height, depth) of <root>/<scene>/depth/<id>.png: metres in row-major order, 0 where unknown."""
    scale = DEPTH_SCALE[source]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(root)
    form = r"/([^/]+)/depth/([^/]+)\.png$"
    rows = files.where(F.col("path").rlike(form)).select(F.regexp_extract("path", form, 1).alias("scene_id"), F.regexp_extract("path", form, 2).alias("frame_id"), "content")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [read_png(c) for c in b["content"]]
            yield pd.DataFrame({"scene_id": b["scene_id"], "frame_id": b["frame_id"], "width": [r.shape[1] for r in found], "height": [r.shape[0] for r in found], "depth": [(r.astype(np.float32) / np.float32(scale)).ravel() for r in found]})

    return rows.mapInPandas(read, "scene_id string, frame_id string, width int, height int, depth array<float>")


def instance_pixels(spark: SparkSession, path: str, frame_ids: list[str] | None = None) -> DataFrame:
    """(member, inst_id, n_px) of label rasters, as instance_rasters() has them."""
    ids = instance_rasters(spark, path, frame_ids).select("member", F.explode("ids").alias("inst_id"))
    return ids.groupBy("member", F.col("inst_id").cast("long").alias("inst_id")).agg(F.count(F.lit(1)).alias("n_px"))


def instance_rasters(spark: SparkSession, path: str, frame_ids: list[str] | None = None) -> DataFrame:
    """(member, width, height, ids) of label rasters in row-major order: PNG files of a folder, or members of zip files there; a broken file gives nothing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).where(F.col("path").rlike(r"\.(png|zip)$")).select("path", "content")

    def members(name: str, content: bytes) -> Iterator[tuple[str, bytes]]:
        if name.endswith(".png"):
            yield name.rpartition("/")[2], content
            return
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for m in z.namelist():
                    if m.endswith(".png"):
                        yield m.rpartition("/")[2], z.read(m)
        except zipfile.BadZipFile:
            return

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"], strict=True):
                for member, png in members(name, content):
                    if frame_ids is None or member.removesuffix(".png") in frame_ids:
                        try:
                            found = read_png(png)
                        except (ValueError, zlib.error, struct.error):
                            continue
                        yield pd.DataFrame({"member": [member], "width": [found.shape[1]], "height": [found.shape[0]], "ids": [found.astype(np.int32).ravel()]})

    return files.mapInPandas(counted, "member string, width int, height int, ids array<int>")
