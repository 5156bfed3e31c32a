"""Image tiles and what image files say of themselves.

``TiffTiles`` reads uncompressed or deflated grey images of 8, 16 or 32 bits tile by tile: a task
reads one page's tiles of a band, whatever the size of the file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Fixed values of the TIFF format: bytes per field type, and tag numbers.
_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 16: 8}
_CODE = {1: "B", 3: "H", 4: "I", 16: "Q"}
_WIDTH, _HEIGHT, _BITS, _COMPRESSION, _STRIPS, _ROWS, _STRIP_BYTES, _TILE_W, _TILE_H, _TILES, _TILE_BYTES, _PREDICTOR = 256, 257, 258, 259, 273, 278, 279, 322, 323, 324, 325, 317


def pages(path: str) -> list[dict[int, tuple[int, ...]]]:
    """The numeric tags of each page of a TIFF or BigTIFF file; key 0 has the byte order."""
    with open(path, "rb") as f:
        head = f.read(16)
        order = "<" if head[:2] == b"II" else ">"
        big = struct.unpack(order + "H", head[2:4])[0] == 43
        at = struct.unpack(order + "Q", head[8:16])[0] if big else struct.unpack(order + "I", head[4:8])[0]
        entry, count, word = (20, "Q", "Q") if big else (12, "H", "I")
        found = []
        while at:
            f.seek(at)
            n = struct.unpack(order + count, f.read(struct.calcsize(count)))[0]
            block = f.read(n * entry)
            at = struct.unpack(order + word, f.read(struct.calcsize(word)))[0]
            tags: dict[int, tuple[int, ...]] = {0: (ord(order),)}
            for k in range(n):
                e = block[k * entry : (k + 1) * entry]
                tag, kind = struct.unpack(order + "HH", e[:4])
                m = struct.unpack(order + word, e[4 : 4 + struct.calcsize(word)])[0]
                if kind not in _CODE:
                    continue
                raw = e[4 + struct.calcsize(word) :]
                if m * _SIZE[kind] > len(raw):
                    f.seek(struct.unpack(order + word, raw[: struct.calcsize(word)])[0])
                    raw = f.read(m * _SIZE[kind])
                tags[tag] = struct.unpack(f"{order}{m}{_CODE[kind]}", raw[: m * _SIZE[kind]])
            found.append(tags)
    return found


def _tile(path: str, tags: dict[int, tuple[int, ...]], k: int) -> tuple[int, int, np.ndarray]:
    """(y0, x0, pixels) of tile or strip ``k`` of a page."""
    width, height = tags[_WIDTH][0], tags[_HEIGHT][0]
    tiled = _TILES in tags
    tw, th = (tags[_TILE_W][0], tags[_TILE_H][0]) if tiled else (width, tags.get(_ROWS, (height,))[0])
    across = -(-width // tw)
    y0, x0 = k // across * th, k % across * tw
    offsets, sizes = (tags[_TILES], tags[_TILE_BYTES]) if tiled else (tags[_STRIPS], tags[_STRIP_BYTES])
    with open(path, "rb") as f:
        f.seek(offsets[k])
        raw = f.read(sizes[k])
    if tags.get(_COMPRESSION, (1,))[0] in (8, 32946):
        raw = zlib.decompress(raw)
    elif tags.get(_COMPRESSION, (1,))[0] != 1:
        raise ValueError(f"compression {tags[_COMPRESSION][0]} of {path}")
    kind = np.dtype({8: "u1", 16: "u2", 32: "u4"}[tags.get(_BITS, (8,))[0]]).newbyteorder(chr(tags[0][0]))
    rows = th if tiled else min(th, height - y0)
    a = np.frombuffer(raw, kind, rows * tw).reshape(rows, tw)
    if tags.get(_PREDICTOR, (1,))[0] == 2:
        a = np.cumsum(a, axis=1, dtype=a.dtype)
    return y0, x0, a[: height - y0, : width - x0]


class _Part(InputPartition):
    def __init__(self, path: str, page: int, first: int, last: int) -> None:
        self.path, self.page, self.first, self.last = path, page, first, last


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], per_task: int) -> None:
        self.paths, self.per_task = paths, per_task

    def partitions(self) -> list[InputPartition]:
        parts: list[InputPartition] = []
        for path in self.paths:
            for k, tags in enumerate(pages(path)):
                n = len(tags.get(_TILES) or tags.get(_STRIPS, ()))
                parts += [_Part(path, k, a, min(a + self.per_task, n)) for a in range(0, n, self.per_task)]
        return parts

    def read(self, part: _Part) -> Iterator[tuple]:
        tags = pages(part.path)[part.page]
        for k in range(part.first, part.last):
            y0, x0, a = _tile(part.path, tags, k)
            yield part.path, part.page, y0, x0, a.shape[0], a.shape[1], f"uint{8 * a.dtype.itemsize}", a.astype(a.dtype.newbyteorder("<")).tobytes()


class TiffTiles(DataSource):
    """``spark.read.format("tiff_tiles").option("paths", "a.tif;b.tif").load()``; a page is a channel."""

    @classmethod
    def name(cls) -> str:
        return "tiff_tiles"

    def schema(self) -> str:
        return "path string, c int, y0 bigint, x0 bigint, h int, w int, dtype string, data binary"

    def reader(self, schema: object) -> DataSourceReader:
        return _Reader(self.options["paths"].split(";"), int(self.options.get("tilesPerTask", "64")))


def pixels(tiles: DataFrame) -> DataFrame:
    """(path, c, y, x, v): the pixels of tiles, for small data."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                a = np.frombuffer(r.data, np.dtype(r.dtype).newbyteorder("<")).reshape(r.h, r.w)
                y, x = np.indices(a.shape)
                yield pd.DataFrame({"path": r.path, "c": r.c, "y": (y + r.y0).ravel(), "x": (x + r.x0).ravel(), "v": a.ravel().astype(np.int64)})

    return tiles.mapInPandas(batches, "path string, c int, y bigint, x bigint, v bigint")


def tile_histograms(tiles: DataFrame, keys: tuple[str, ...] = ("path", "c")) -> DataFrame:
    """(keys, v, n): exact histograms, counted tile by tile before anything is shuffled (A1)."""
    kinds = ", ".join(f"`{k}` {tiles.schema[k].dataType.simpleString()}" for k in keys)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, r in frame.iterrows():
                v, n = np.unique(np.frombuffer(r["data"], np.dtype(r["dtype"]).newbyteorder("<")), return_counts=True)
                yield pd.DataFrame({**{k: r[k] for k in keys}, "v": v.astype(np.int64), "n": n})

    parts = tiles.select(*keys, "dtype", "data").mapInPandas(batches, f"{kinds}, v bigint, n bigint")
    return parts.groupBy(*keys, "v").agg(F.sum("n").alias("n"))


def picked_level(levels: DataFrame, most: int) -> DataFrame:
    """(path, level): the finest level whose longer side is at most ``most``, else the coarsest."""
    fits = F.min(F.when(F.greatest("h", "w") <= most, F.col("level")))
    return levels.groupBy("path").agg(F.coalesce(fits, F.max("level")).alias("level"))


def channel_names(sidecar: Column, vendor_xml: Column, ome_xml: Column, n_channels: Column) -> Column:
    """The names of an image's channels, from the first source that has them all.

    A sidecar list of the right length; the vendor's XML, if no name is empty; OME names; ``chNN``.
    """
    whole = lambda a: F.when((F.size(a) == n_channels) & ~F.exists(a, lambda x: F.trim(x) == ""), a)
    vendor = F.coalesce(whole(F.xpath(vendor_xml, F.lit("//Biomarker/text()"))), whole(F.xpath(vendor_xml, F.lit("//Name/text()"))))
    plain = F.transform(F.sequence(F.lit(0), n_channels - 1), lambda i: F.concat(F.lit("ch"), F.lpad(i.cast("string"), 2, "0")))
    return F.coalesce(F.when(F.size(sidecar) == n_channels, sidecar), vendor, whole(F.xpath(ome_xml, F.lit("//*[local-name()='Channel']/@Name"))), plain)


def pixel_size(override: Column, ome_xml: Column, vendor_xml: Column, resolution: Column, unit: Column) -> Column:
    """um per pixel and where it comes from (S10): override, OME, vendor XML, resolution tag; NULL if none tells.

    A resolution per inch of 72, 96 or 300 is a default of writers and tells nothing.
    """
    ome = F.xpath_double(ome_xml, F.lit("//*[local-name()='Pixels']/@PhysicalSizeX"))
    ome_unit = F.xpath_string(ome_xml, F.lit("//*[local-name()='Pixels']/@PhysicalSizeXUnit"))
    ome = F.when(~F.isnan(ome), F.when(ome_unit == "nm", ome / 1000).otherwise(ome))
    vendor = F.regexp_extract(vendor_xml, r"<PixelSizeMicrons>\s*([0-9.]+)", 1).try_cast("double")
    tag = F.when(unit == "cm", F.try_divide(F.lit(1e4), resolution)).when((unit == "inch") & ~resolution.isin(72, 96, 300), F.try_divide(F.lit(25400.0), resolution))
    source = F.when(override.isNotNull(), "override").when(ome.isNotNull(), "ome").when(vendor.isNotNull(), "vendor").when(tag.isNotNull(), "tag").otherwise("not found")
    return F.struct(F.coalesce(override, ome, vendor, tag).alias("um"), source.alias("source"))


def axis_order(axes: Column) -> Column:
    """Where channels, rows and columns stand among the axes of an image, from 0.

    Planes, samples and other sequences count as channels; an image of rows and columns only
    has one channel, at -1. Any other axes are an error.
    """
    named = F.translate(F.upper(axes), "ISQ", "CCC")
    at = F.transform(F.array(*map(F.lit, "CYX")), lambda a: F.position(a, named) - 1)
    wrong = F.raise_error(F.concat(F.lit("no image of channels, rows and columns: "), F.coalesce(axes, F.lit("NULL"))))
    whole = F.array_join(F.array_sort(F.split(named, "")), "") == "CXY"
    return F.when((named == "YX") | whole, at).otherwise(wrong.cast("array<int>"))


def level_factor(height: Column, level_height: Column) -> Column:
    """How many rows of the full image one row of a level stands for."""
    return height / level_height
