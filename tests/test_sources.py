import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slideloom.sources import images as I, sheets as S


def write_tiff(path, pages, tile=16, order="<", deflate=True):
    """A tiled TIFF of grey pages, for the reader to read."""
    body, tables = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0)), []
    for a in pages:
        a = a.astype(a.dtype.newbyteorder(order))
        offsets, sizes = [], []
        for y in range(0, a.shape[0], tile):
            for x in range(0, a.shape[1], tile):
                t = np.zeros((tile, tile), a.dtype)
                part = a[y : y + tile, x : x + tile]
                t[: part.shape[0], : part.shape[1]] = part
                raw = zlib.compress(t.tobytes()) if deflate else t.tobytes()
                offsets.append(len(body))
                sizes.append(len(raw))
                body += raw
        lists = []
        for v in (offsets, sizes):
            lists.append(len(body))
            body += struct.pack(f"{order}{len(v)}I", *v)
        tables.append((a, offsets, sizes, lists))
    link = 4
    for a, offsets, sizes, lists in tables:
        struct.pack_into(order + "I", body, link, len(body))
        n = len(offsets)
        one = lambda v: struct.pack(order + "I", v)
        tags = [(256, 1, one(a.shape[1])), (257, 1, one(a.shape[0])), (258, 1, one(a.dtype.itemsize * 8)), (259, 1, one(8 if deflate else 1)), (322, 1, one(tile)), (323, 1, one(tile)),
                (324, n, one(lists[0] if n > 1 else offsets[0])), (325, n, one(lists[1] if n > 1 else sizes[0]))]
        body += struct.pack(order + "H", len(tags)) + b"".join(struct.pack(order + "HHI", t, 4, m) + v for t, m, v in tags)
        link = len(body)
        body += struct.pack(order + "I", 0)
    path.write_bytes(bytes(body))


@pytest.mark.parametrize("order, deflate", [("<", True), (">", False)])
def test_tiff_tiles(spark, tmp_path, order, deflate):
    rng = np.random.default_rng(0)
    pages = [rng.integers(0, 60_000, (40, 23)).astype("u2"), rng.integers(0, 9, (40, 23)).astype("u2")]
    path = tmp_path / "a.tif"
    write_tiff(path, pages, order=order, deflate=deflate)
    spark.dataSource.register(I.TiffTiles)
    tiles = spark.read.format("tiff_tiles").option("paths", str(path)).option("tilesPerTask", "2").load()
    got = np.zeros((2, 40, 23), int)
    for r in I.pixels(tiles).collect():
        got[r.c, r.y, r.x] = r.v
    assert (got[0] == pages[0]).all() and (got[1] == pages[1]).all()
    h = {(r.c, r.v): r.n for r in I.tile_histograms(tiles).collect()}
    v, n = np.unique(pages[1], return_counts=True)
    assert {k[1]: m for k, m in h.items() if k[0] == 1} == dict(zip(v.tolist(), n.tolist()))


def test_axes(spark):
    given = spark.createDataFrame([("CYX",), ("yxs",), ("IYX",), ("YX",), ("XYQ",)], "axes string")
    assert [r[0] for r in given.select(I.axis_order(F.col("axes"))).collect()] == [[0, 1, 2], [2, 0, 1], [0, 1, 2], [-1, 0, 1], [2, 1, 0]]
    for wrong in ("ZYX", "CCYX", "Y", None):
        with pytest.raises(Exception, match="no image of channels"):
            spark.createDataFrame([(wrong,)], "axes string").select(I.axis_order(F.col("axes"))).collect()


def test_metadata(spark):
    df = spark.createDataFrame([
        (["x", "y"], None, None, 2), (["x"], "<a><Biomarker>CD3</Biomarker><Biomarker>CD8</Biomarker></a>", None, 2), (None, "<a><Biomarker>CD3</Biomarker><Biomarker> </Biomarker></a>", '<OME><Channel Name="p"/><Channel Name="q"/></OME>', 2), (None, None, None, 2),
    ], "side array<string>, vendor string, ome string, n int")
    got = [r[0] for r in df.select(I.channel_names(F.col("side"), F.col("vendor"), F.col("ome"), F.col("n"))).collect()]
    assert got == [["x", "y"], ["CD3", "CD8"], ["p", "q"], ["ch00", "ch01"]]
    sizes = spark.createDataFrame([
        (0.3, None, None, 300.0, "inch"), (None, '<OME><Pixels PhysicalSizeX="500" PhysicalSizeXUnit="nm"/></OME>', None, None, None), (None, None, "<PixelSizeMicrons>0.25</PixelSizeMicrons>", None, None),
        (None, None, None, 20000.0, "cm"), (None, None, None, 300.0, "inch"), (None, None, None, 50800.0, "inch"),
    ], "o double, ome string, vendor string, r double, u string")
    got = [tuple(r[0]) for r in sizes.select(I.pixel_size(*map(F.col, ("o", "ome", "vendor", "r", "u")))).collect()]
    assert got == [(0.3, "override"), (0.5, "ome"), (0.25, "vendor"), (0.5, "tag"), (None, "not found"), (0.5, "tag")]
    levels = spark.createDataFrame([("a", 0, 900, 800), ("a", 1, 450, 400), ("a", 2, 225, 200), ("b", 0, 900, 9)], "path string, level int, h int, w int")
    assert sorted(map(tuple, I.picked_level(levels, 500).collect())) == [("a", 1), ("b", 0)]


def feature(geometry, **properties):
    return {"type": "Feature", "geometry": geometry, "properties": properties}


def test_outlines(spark):
    ring = [[0, 0], [4, 0], [4, 3.5], [0, 0]]
    texts = [
        ("a", json.dumps({"type": "FeatureCollection", "features": [
            feature({"type": "Polygon", "coordinates": [ring, ring]}, objectType="annotation", classification={"name": "Tumor"}),
            feature({"type": "MultiPolygon", "coordinates": [[ring], [ring]]}, objectType="detection", name="n"),
            feature({"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": [ring]}, {"type": "Point", "coordinates": [1, 2]}]}, classification="Plain"),
        ]})),
        ("b", json.dumps([feature({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}), feature({"type": "Polygon", "coordinates": [ring]}, name="Grouth truth")])),
        ("c", json.dumps({"type": "Polygon", "coordinates": [ring]})), ("d", "not json"), ("e", None), ("f", "{}"),
    ]
    out = S.with_role(S.outlines(spark.createDataFrame(texts, "path string, value string"))).collect()
    by = {}
    for r in out:
        by.setdefault(r.path, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"a": 5, "b": 2, "c": 1}
    assert sorted(str(r.classification) for r in by["a"]) == ["Plain", "Plain", "Tumor", "n", "n"]
    tumor = next(r for r in by["a"] if r.classification == "Tumor")
    assert tumor.is_region and len(tumor.rings) == 2 and tuple(tumor.rings[0][2]) == (4.0, 3.5)
    assert [r.is_region for r in by["b"] if r.kind == "polygon"] == [True] and not any(r.is_region for r in by["a"] if r.object_type == "detection")


def test_sheets(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Marker , ALIASES,extra\n"CD8, total",,x\n F480 ,"a;b",\n')
    rows = S.read_sheet(spark, str(tmp_path / "p.csv"), ("marker", "aliases", "role")).collect()
    assert [tuple(r) for r in rows] == [("CD8, total", "", ""), ("F480", "a;b", "")]
    (tmp_path / "r.csv").write_text("x_px,y_px\n1.5,2\nbad,3\n")
    assert [tuple(r) for r in S.read_points(spark, str(tmp_path / "r.csv")).collect()] == [(1.5, 2.0, None, None), (None, 3.0, None, None)]
    assert S.fingerprints(spark, str(tmp_path / "r.csv")).collect()[0].length == 22


def test_streamed_counts_are_idempotent(spark, tmp_path):
    from slideloom.streaming import merge_histograms, stored_histograms

    src = str(tmp_path / "in")
    spark.createDataFrame([(1, 5), (1, 5), (2, 7)], "c int, v bigint").write.parquet(src)
    for _ in range(2):
        stream = spark.readStream.schema("c int, v bigint").parquet(src)
        merge_histograms(stream, ["c"], str(tmp_path / "store"), str(tmp_path / "state")).awaitTermination()
    assert sorted(map(tuple, stored_histograms(spark, str(tmp_path / "store")).select("c", "v", "n").collect())) == [(1, 5, 2), (2, 7, 1)]
