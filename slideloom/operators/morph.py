"""Distance transform, watershed and prediction over tiles."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F


def lower_envelope(at: np.ndarray, height: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least of (y - at)^2 + height at each ``y``; both ``at`` and ``y`` ascend, and the work is linear in them."""
    kept, starts = [0], [-np.inf]  # parabolas of the envelope, and from where each is the lowest
    a, h = at.tolist(), height.tolist()
    for k in range(1, len(a)):
        while True:
            j = kept[-1]
            start = (h[k] + a[k] * a[k] - h[j] - a[j] * a[j]) / (2 * (a[k] - a[j]))
            if start > starts[-1]:
                break
            kept.pop()
            starts.pop()
        kept.append(k)
        starts.append(start)
    lowest = np.array(kept)[np.searchsorted(starts, y, side="right") - 1]
    return (y - at[lowest]) ** 2 + height[lowest]


def distance_transform(mask: DataFrame, image: str = "img") -> DataFrame:
    """(img, y, x, d): the distance of each pixel of ``mask`` (img, y, x, inside) from the nearest one not inside.

    Two passes: along rows, then down each column by its lower envelope. A task handles one row
    or one column of the reduced raster; places without a pixel are laid out for it. An image
    without any outside pixel has NULL distances.
    """
    pixels = mask.groupBy(image, "y", "x").agg(F.max("inside").alias("inside"))
    ends = pixels.groupBy(image).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    kind = pixels.schema[image].dataType.simpleString()

    def row(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.arange(rows["lo"].iloc[0], rows["hi"].iloc[0] + 1)
        out = np.sort(rows["x"].to_numpy(float)[~rows["inside"].to_numpy(bool)])
        g = np.full(len(x), np.nan)
        if len(out):
            at = np.searchsorted(out, x)
            g = np.minimum(np.abs(x - out[np.maximum(at - 1, 0)]), np.abs(out[np.minimum(at, len(out) - 1)] - x))
        return pd.DataFrame({image: rows[image].iloc[0], "y": rows["y"].iloc[0], "x": x, "g": g, "own": np.isin(x, rows["x"])})

    def column(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("y")
        y, g = rows["y"].to_numpy(float), rows["g"].to_numpy(float)
        known = np.flatnonzero(~np.isnan(g))
        d = np.sqrt(lower_envelope(y[known], g[known] ** 2, y)) if len(known) else np.full(len(y), np.nan)
        return rows[[image, "y", "x"]].assign(d=d)[rows["own"]]

    first = pixels.join(ends, image).groupBy(image, "y").applyInPandas(row, f"`{image}` {kind}, y bigint, x bigint, g double, own boolean")
    found = first.groupBy(image, "x").applyInPandas(column, f"`{image}` {kind}, y bigint, x bigint, d double")
    return found.withColumn("d", F.when(~F.isnan("d"), F.round("d", 6)))


def with_halo(pixels: DataFrame, tile: int, halo: int) -> DataFrame:
    """``pixels`` with the tiles (ty, tx) that need each of them: its own and those it lies within ``halo`` of."""
    of = lambda c: F.sequence(F.floor((F.col(c) - halo) / tile).cast("bigint"), F.floor((F.col(c) + halo) / tile).cast("bigint"))
    return pixels.withColumn("ty", F.explode(of("y"))).withColumn("tx", F.explode(of("x"))).where("ty >= 0 and tx >= 0")


def flood(elevation: np.ndarray, markers: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Markers grown over the mask, the lowest elevation first; equal ones in the order they are reached."""
    out = np.where(inside, markers, 0)
    queue = [(elevation[y, x], k, y, x) for k, (y, x) in enumerate(zip(*np.nonzero(out)))]
    heapq.heapify(queue)
    count = len(queue)
    while queue:
        _, _, y, x = heapq.heappop(queue)
        for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
            if 0 <= a < out.shape[0] and 0 <= b < out.shape[1] and inside[a, b] and not out[a, b]:
                out[a, b] = out[y, x]
                heapq.heappush(queue, (elevation[a, b], count, a, b))
                count += 1
    return out


def by_tile(pixels: DataFrame, tile: int, halo: int, columns: Sequence[str], work: Callable[..., np.ndarray], unique: bool = False) -> DataFrame:
    """(img, ty, tx, y, x, label): ``work`` on each tile with its halo, the tile's own pixels kept.

    ``pixels`` has img, y, x and ``columns``; missing pixels count as 0. ``work`` gets one array
    per column and gives the labels. Repeated places count with their largest values, unless
    ``unique`` says that there are none. A group is a tile of (tile + 2 * halo)^2 pixels at most;
    tiles without pixels are skipped.
    """
    side = tile + 2 * halo
    kind = pixels.schema["img"].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(rows["ty"].iloc[0]), int(rows["tx"].iloc[0])
        y, x = (rows["y"] - ty * tile + halo).to_numpy(), (rows["x"] - tx * tile + halo).to_numpy()
        arrays = []
        for c in columns:
            a = np.zeros((side, side), rows[c].to_numpy().dtype if rows[c].dtype != object else float)
            a[y, x] = rows[c]
            arrays.append(a)
        labels = work(*arrays)
        own = labels[halo : halo + tile, halo : halo + tile]
        iy, ix = np.nonzero(own)
        return pd.DataFrame({"img": rows["img"].iloc[0], "ty": ty, "tx": tx, "y": iy + ty * tile, "x": ix + tx * tile, "label": own[iy, ix].astype(np.int64)})

    once = pixels if unique else pixels.groupBy("img", "y", "x").agg(*[F.max(c).alias(c) for c in columns])
    laid = with_halo(once, tile, halo)
    return laid.groupBy("img", "ty", "tx").applyInPandas(run, f"img {kind}, ty bigint, tx bigint, y bigint, x bigint, label bigint")


def nearest_labels(labels: np.ndarray, distance: int) -> np.ndarray:
    """Labels grown into the background by ``distance``, nearest first, then the smallest label."""
    rings: dict[int, list[tuple[int, int]]] = {}
    for dy in range(-distance, distance + 1):
        for dx in range(-distance, distance + 1):
            if 0 < dy * dy + dx * dx <= distance * distance:
                rings.setdefault(dy * dy + dx * dx, []).append((dy, dx))
    labels, none = labels.astype(np.int64), np.iinfo(np.int64).max
    wide = np.pad(np.where(labels > 0, labels, none), distance, constant_values=none)
    out, (h, w) = labels.copy(), labels.shape
    for _, offsets in sorted(rings.items()):
        near = np.minimum.reduce([wide[distance + dy : distance + dy + h, distance + dx : distance + dx + w] for dy, dx in offsets])
        fill = (out == 0) & (near < none)
        out[fill] = near[fill]
    return out


def watershed(pixels: DataFrame, tile: int, halo: int) -> DataFrame:
    """(img, y, x, label): markers grown over ``inside`` by ``elevation``, tile by tile.

    ``pixels`` has img, y, x, elevation, marker and inside. Growth beyond the halo is cut off at
    the tile, so the halo is to be as wide as labels may grow.
    """
    grown = by_tile(pixels.withColumn("inside", F.col("inside").cast("int")), tile, halo, ["elevation", "marker", "inside"], lambda e, m, i: flood(e, m.astype(np.int64), i > 0))
    return grown.select("img", "y", "x", "label")


def distance_within(inside: np.ndarray, most: int) -> np.ndarray:
    """The distance of each pixel from the nearest one inside, infinite beyond ``most``."""
    wide, (h, w) = np.pad(inside, most), inside.shape
    out = np.full((h, w), np.inf)
    for dy in range(-most, most + 1):
        for dx in range(-most, most + 1):
            if (d := dy * dy + dx * dx) <= most * most:
                hit = wide[most + dy : most + dy + h, most + dx : most + dx + w]
                out[hit] = np.minimum(out[hit], d)
    return np.sqrt(out)


def propagated(pixels: DataFrame, tile: int, grow: int, weight: float) -> DataFrame:
    """(img, y, x, label): nuclei grown at most ``grow`` pixels over ``inside``, tile by tile.

    ``pixels`` has img, y, x, elevation, marker and inside; markers are the nuclei and stay whole.
    A pixel is reached if a nucleus is at most ``grow`` from it, and lies higher by ``weight`` times
    its share of that distance. Growth goes from neighbour to neighbour, so that each piece of a
    label touches its own nucleus. The halo is 2 * grow + 4, as in the reference.
    """

    def work(elevation: np.ndarray, marker: np.ndarray, inside: np.ndarray) -> np.ndarray:
        nuclei = marker.astype(np.int64)
        d = distance_within(nuclei > 0, grow)
        reached = (nuclei > 0) | ((inside > 0) & (d <= grow))
        return flood(elevation + weight * np.where(reached, d, 0) / grow if grow else elevation, nuclei, reached)

    rows = pixels.withColumn("inside", F.col("inside").cast("int"))
    return by_tile(rows, tile, 2 * grow + 4, ["elevation", "marker", "inside"], work).select("img", "y", "x", "label")


def threshold_objects(limit: float) -> Callable[[np.ndarray], np.ndarray]:
    """A stand-in predictor: connected pieces above a limit, numbered by first pixel."""

    def predict(nuclear: np.ndarray) -> np.ndarray:
        inside = nuclear > limit
        out = np.zeros(inside.shape, np.int64)
        count = 0
        for y, x in zip(*np.nonzero(inside)):
            if out[y, x]:
                continue
            count += 1
            out[y, x], stack = count, [(y, x)]
            while stack:
                a, b = stack.pop()
                for p in range(max(a - 1, 0), min(a + 2, out.shape[0])):
                    for q in range(max(b - 1, 0), min(b + 2, out.shape[1])):
                        if inside[p, q] and not out[p, q]:
                            out[p, q] = count
                            stack.append((p, q))
        return out

    return predict


def predicted(pixels: DataFrame, tile: int, halo: int, predict: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(img, y, x, label): objects of a predictor run on tiles with halo.

    Each tile keeps the objects whose centroid lies on its own pixels, whole, and numbers are
    made unique by tile; a pixel that objects of two tiles claim goes to the earlier tile.
    """
    side = tile + 2 * halo
    kind = pixels.schema["img"].dataType.simpleString()

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ty, tx = int(rows["ty"].iloc[0]), int(rows["tx"].iloc[0])
        image = np.zeros((side, side))
        image[(rows["y"] - ty * tile + halo).to_numpy(), (rows["x"] - tx * tile + halo).to_numpy()] = rows["v"]
        labels = predict(image)
        y, x = np.nonzero(labels)
        found = pd.DataFrame({"y": y + ty * tile - halo, "x": x + tx * tile - halo, "local": labels[y, x].astype(np.int64)})
        centre = found.groupby("local")[["y", "x"]].mean()
        own = centre[(np.floor(centre["y"] / tile) == ty) & (np.floor(centre["x"] / tile) == tx)].index
        found = found[found["local"].isin(own)]
        return found.assign(img=rows["img"].iloc[0], ty=ty, tx=tx)[["img", "ty", "tx", "y", "x", "local"]]

    laid = with_halo(pixels.groupBy("img", "y", "x").agg(F.max("v").alias("v")), tile, halo)
    found = laid.groupBy("img", "ty", "tx").applyInPandas(run, f"img {kind}, ty bigint, tx bigint, y bigint, x bigint, local bigint")
    # A tile has fewer than 2**20 objects and an image fewer than 2**20 tiles on a side.
    label = (F.col("ty") * 2**20 + F.col("tx")) * 2**20 + F.col("local")
    return found.groupBy("img", "y", "x").agg(F.min(label).alias("label"))


def dense_tiles(labels: DataFrame, tile: int) -> DataFrame:
    """(img, ty, tx, size, data): labels as little-endian uint32 rasters of whole tiles, compressed (K4)."""
    import zlib

    of = lambda c: F.floor(F.col(c) / tile).cast("bigint").alias(f"t{c}")
    kind = labels.schema["img"].dataType.simpleString()

    def raster(rows: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((tile, tile), "<u4")
        a[(rows["y"] % tile).to_numpy(), (rows["x"] % tile).to_numpy()] = rows["label"]
        return pd.DataFrame({"img": [rows["img"].iloc[0]], "ty": [rows["ty"].iloc[0]], "tx": [rows["tx"].iloc[0]], "size": [tile], "data": [zlib.compress(a.tobytes())]})

    placed = labels.select("img", of("y"), of("x"), "y", "x", "label")
    return placed.groupBy("img", "ty", "tx").applyInPandas(raster, f"img {kind}, ty bigint, tx bigint, size int, data binary")
