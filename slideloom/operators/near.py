"""Points near other points, and points within regions, by a dual-tree join.

Both sides are trees of bounding nodes. The upper tree is a quadtree over tiles whose nodes
carry counts and bounding boxes; Spark compares its nodes level by level, drops pairs that
are farther apart than the distance, and keeps on refining the rest down to the leaves. Each
pair of leaves left over becomes work of a distributed task, where the recursion goes on over
a balanced tree of the leaf's points: impossible node pairs are dropped, pairs certainly near
are accepted wholesale, and only uncertain ones are compared point by point.

A tile that holds too many points even at the smallest size is hot: repeats of its points are
removed by an aggregation, and it is refined further, down to tiles as small as half the
distance. What is still too full there is cut into blocks, and each pair of blocks is a task of
its own with the points of these two only. A leaf gets the points near to it from leaves of its
own size or larger ones, which are few.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from slideloom.session import checkpointed

#: Side of the smallest tile in px; each level above has tiles of four times the side.
BASE_TILE = 128.0
FAN_BITS = 2
#: Points of a leaf; a leaf above it is refined, or cut into blocks at the smallest tile.
LEAF_POINTS = 32_768
#: Points of a block at most, about; all pairs of two blocks may be near.
BLOCK_POINTS = 4_096
#: Levels of smaller tiles in a hot tile, at most.
MOST_FINE = 6
_BUCKET = 12
_CHUNK = 1 << 21

_POINT, _HALO, _EDGE = 0, 1, 2


# --- the recursion inside a task -----------------------------------------------------------


class _Tree:
    """A balanced tree over points: level k has 2**k nodes with equally many points each.

    The last point is repeated to fill the last nodes; repeats have ``order`` >= n.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray) -> None:
        self.n = len(x)
        self.depth = max(0, math.ceil(math.log2(max(1.0, self.n / _BUCKET))))
        leaves = 1 << self.depth
        size = -(-self.n // leaves)
        order = np.arange(size * leaves)
        self.x = np.concatenate([x, np.full(len(order) - self.n, x[-1])])
        self.y = np.concatenate([y, np.full(len(order) - self.n, y[-1])])
        for k in range(self.depth):
            nodes = order.reshape(1 << k, -1)
            px, py = self.x[nodes], self.y[nodes]
            wide = np.ptp(px, axis=1) >= np.ptp(py, axis=1)
            by = np.argsort(np.where(wide[:, None], px, py), axis=1, kind="stable")
            nodes = np.take_along_axis(nodes, by, axis=1)
            order = nodes.reshape(-1)  # a node's halves are its children
        self.order = order
        self.boxes: list[tuple[np.ndarray, ...]] = []
        bx, by_ = self.x[order].reshape(leaves, size), self.y[order].reshape(leaves, size)
        box = (bx.min(1), bx.max(1), by_.min(1), by_.max(1))
        for _ in range(self.depth + 1):
            self.boxes.append(box)
            if len(box[0]) > 1:
                lo, hi = (lambda v: np.minimum(v[::2], v[1::2])), (lambda v: np.maximum(v[::2], v[1::2]))
                box = (lo(box[0]), hi(box[1]), lo(box[2]), hi(box[3]))
        self.boxes.reverse()
        self.buckets = order.reshape(leaves, size)


def close_pairs(x: np.ndarray, y: np.ndarray, own: np.ndarray, distance: float, crossed: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of points at most ``distance`` apart, at least one of them ``own``; exactly one if ``crossed``."""
    none = np.empty(0, np.int64)
    if len(x) < 2:
        return none, none
    tree, limit = _Tree(x, y), distance * distance
    first, second = [none], [none]

    def give(i: np.ndarray, j: np.ndarray, same: np.ndarray) -> None:
        good = (i < tree.n) & (j < tree.n) & (~same | (i < j))
        i, j = i[good], j[good]
        good = own[i] != own[j] if crossed else own[i] | own[j]
        first.append(i[good])
        second.append(j[good])

    def all_of(a: np.ndarray, b: np.ndarray, level: int) -> None:
        """Every pair of points of two nodes, without a distance taken."""
        nodes = tree.order.reshape(1 << level, -1)
        size = nodes.shape[1]
        step = max(1, _CHUNK // (size * size))
        for at in range(0, len(a), step):
            p, q = nodes[a[at : at + step]], nodes[b[at : at + step]]
            shape = (len(p), size, size)
            i, j = np.broadcast_to(p[:, :, None], shape).reshape(-1), np.broadcast_to(q[:, None, :], shape).reshape(-1)
            give(i, j, np.repeat(a[at : at + step] == b[at : at + step], size * size))

    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(tree.depth + 1):
        x0, x1, y0, y1 = tree.boxes[level]
        dx = np.maximum(0, np.maximum(x0[a] - x1[b], x0[b] - x1[a]))
        dy = np.maximum(0, np.maximum(y0[a] - y1[b], y0[b] - y1[a]))
        keep = dx * dx + dy * dy <= limit
        a, b = a[keep], b[keep]
        fx, fy = np.maximum(x1[a], x1[b]) - np.minimum(x0[a], x0[b]), np.maximum(y1[a], y1[b]) - np.minimum(y0[a], y0[b])
        sure = fx * fx + fy * fy <= limit
        all_of(a[sure], b[sure], level)
        a, b = a[~sure], b[~sure]
        if level < tree.depth:
            a2, b2 = 2 * a, 2 * b
            cross = a != b
            a = np.concatenate([a2, a2 + 1, a2, (a2 + 1)[cross]])
            b = np.concatenate([b2, b2 + 1, b2 + 1, b2[cross]])
    size = tree.buckets.shape[1]
    step = max(1, _CHUNK // (size * size))
    for at in range(0, len(a), step):
        p, q = tree.buckets[a[at : at + step]], tree.buckets[b[at : at + step]]
        d = (tree.x[p][:, :, None] - tree.x[q][:, None, :]) ** 2 + (tree.y[p][:, :, None] - tree.y[q][:, None, :]) ** 2
        m, i, j = np.nonzero(d <= limit)
        give(p[m, i], q[m, j], (a[at : at + step] == b[at : at + step])[m])
    return np.concatenate(first), np.concatenate(second)


def _odd(px: np.ndarray, py: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether a ray to the right of each point crosses the edges an odd number of times."""
    x1, y1, x2, y2 = (edges[:, k][:, None] for k in range(4))
    inside = np.zeros(len(px), bool)
    step = max(1, _CHUNK // max(1, len(edges)))
    for at in range(0, len(px), step):
        x, y = px[None, at : at + step], py[None, at : at + step]
        with np.errstate(divide="ignore", invalid="ignore"):
            crossed = ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
        inside[at : at + step] = crossed.sum(0) % 2 == 1
    return inside


def points_within(tree: _Tree, ring: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Indices of the tree's points inside ring 0 and inside none of the other rings.

    Nodes that no edge touches lie wholly on one side: they are accepted or dropped by one
    test of a point of theirs. Nodes that an edge touches are refined.
    """
    rings = [edges[ring == k] for k in np.unique(ring)]
    if not len(ring) or ring.min() != 0:
        return np.empty(0, np.int64)

    def held(px: np.ndarray, py: np.ndarray) -> np.ndarray:
        inside = _odd(px, py, rings[0])
        for hole in rings[1:]:
            at = np.flatnonzero(inside)
            if len(at):
                inside[at] &= ~_odd(px[at], py[at], hole)
        return inside

    ex0, ex1 = np.minimum(edges[:, 0], edges[:, 2]), np.maximum(edges[:, 0], edges[:, 2])
    ey0, ey1 = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    nodes, accepted = np.zeros(1, np.int64), []
    per = tree.buckets.shape[1]
    for level in range(tree.depth + 1):
        x0, x1, y0, y1 = (v[nodes] for v in tree.boxes[level])
        # Edges left of the leaf are not here, so a node may lie left of all edges and yet inside.
        outer = (x0 <= ex1.max()) & (y0 <= ey1.max()) & (y1 >= ey0[ring == 0].min())
        nodes, x0, x1, y0, y1 = nodes[outer], x0[outer], x1[outer], y0[outer], y1[outer]
        if not len(nodes):
            break
        touched = np.zeros(len(nodes), bool)
        step = max(1, _CHUNK // len(edges))
        for at in range(0, len(nodes), step):
            u0, u1, v0, v1 = (v[at : at + step, None] for v in (x0, x1, y0, y1))
            touched[at : at + step] = ((ex0[None] <= u1) & (ex1[None] >= u0) & (ey0[None] <= v1) & (ey1[None] >= v0)).any(1)
        clear = np.flatnonzero(~touched)
        if len(clear):
            whole = nodes[clear[held(x0[clear], y0[clear])]]
            span = per << (tree.depth - level)
            accepted.append((whole[:, None] * span + np.arange(span)[None]).reshape(-1))
        nodes = nodes[touched]
        if level < tree.depth:
            nodes = np.concatenate([2 * nodes, 2 * nodes + 1])
    found = [tree.order[np.concatenate(accepted)]] if accepted else []
    if len(nodes):
        index = tree.buckets[nodes].reshape(-1)
        found.append(index[held(tree.x[index], tree.y[index])])
    if not found:
        return np.empty(0, np.int64)
    index = np.concatenate(found)
    return index[index < tree.n]


_FOUND = pa.schema([("image", pa.string()), ("near_kind", pa.string()), ("id_a", pa.int64()), ("id_b", pa.int64())])


def _task(distance: float):
    def found_in(key: tuple, table: pa.Table) -> pa.Table:
        col = lambda name: table.column(name).to_numpy()
        kind, ids, x, y = col("kind"), col("id"), col("x"), col("y")
        point = kind != _EDGE
        own = kind[point] == _POINT
        # A point exported again at its place is the same point here.
        rows = np.unique(
            np.rec.fromarrays([~own, ids[point], x[point], y[point]], names="halo,id,x,y")
        ) if point.any() else np.rec.fromarrays([np.empty(0, bool), np.empty(0, np.int64), np.empty(0), np.empty(0)], names="halo,id,x,y")
        a = b = np.empty(0, np.int64)
        if len(rows) > 1 and distance >= 0:
            i, j = close_pairs(rows.x, rows.y, ~rows.halo, distance, crossed=key[_TASK.index("pair")].as_py() is not None)
            a, b = np.minimum(rows.id[i], rows.id[j]), np.maximum(rows.id[i], rows.id[j])
            pairs = np.unique(np.stack([a, b], 1)[a != b], axis=0)
            a, b = pairs[:, 0], pairs[:, 1]
        sa, sb = [], []
        mine = rows[~rows.halo]
        if len(mine) and not point.all():
            edge = ~point
            shape, ring = ids[edge], col("ring")[edge]
            edges = np.stack([x[edge], y[edge], col("x2")[edge], col("y2")[edge]], 1)
            tree = _Tree(mine.x, mine.y)
            by = np.argsort(shape, kind="stable")
            shape, ring, edges = shape[by], ring[by], edges[by]
            for s, at, to in zip(*(v.tolist() for v in _runs(shape))):
                inside = np.unique(mine.id[points_within(tree, ring[at:to], edges[at:to])])
                sa.append(inside)
                sb.append(np.full(len(inside), s, np.int64))
        a, b = np.concatenate([a, *sa]), np.concatenate([b, *sb])
        kinds = pa.array(np.repeat(["cell", "shape"], [len(a) - sum(map(len, sa)), sum(map(len, sa))]))
        image = pa.array([key[0].as_py()], pa.string()).take(pa.array(np.zeros(len(a), np.int64)))
        return pa.table([image, kinds.cast(pa.string()), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], schema=_FOUND)

    return found_in


_ODD = pa.schema([("image", pa.string()), ("id_a", pa.int64()), ("id_b", pa.int64()), ("ring", pa.int32())])
#: Points for which the edges of their heights are looked up at once.
_BAND = 256


def _odd_in(key: tuple, table: pa.Table) -> pa.Table:
    """(image, point, shape, ring) where a ray to the right of the point crosses these edges an odd number of times."""
    col = lambda name: table.column(name).to_numpy()
    ids, x, y, edge = col("id"), col("x"), col("y"), col("kind") == _EDGE
    rows = np.unique(np.rec.fromarrays([y[~edge], x[~edge], ids[~edge]], names="y,x,id")) if not edge.all() else np.rec.fromarrays([x[:0], x[:0], ids[:0]], names="y,x,id")
    shape, ring = ids[edge], col("ring")[edge].astype(np.int32)
    edges = np.stack([x[edge], y[edge], col("x2")[edge], col("y2")[edge]], 1)
    by = np.lexsort((ring, shape))
    shape, ring, edges = shape[by], ring[by], edges[by]
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    a, b, r = [], [], []
    if len(rows):
        starts = np.flatnonzero(np.r_[True, (shape[1:] != shape[:-1]) | (ring[1:] != ring[:-1])]) if len(shape) else []
        for at, to in zip(starts, [*starts[1:], len(shape)]):
            for first in range(0, len(rows), _BAND):
                band = rows[first : first + _BAND]
                met = edges[at:to][(low[at:to] <= band.y[-1]) & (high[at:to] >= band.y[0])]
                odd = band.id[_odd(band.x, band.y, met)] if len(met) else band.id[:0]
                a.append(odd)
                b.append(np.full(len(odd), shape[at]))
                r.append(np.full(len(odd), ring[at]))
    whole = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts]).astype(kind)
    a, b, r = whole(a, np.int64), whole(b, np.int64), whole(r, np.int32)
    image = pa.array([key[0].as_py()], pa.string()).take(pa.array(np.zeros(len(a), np.int64)))
    return pa.table([image, pa.array(a), pa.array(b), pa.array(r)], schema=_ODD)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[at], at, np.r_[at[1:], len(values)]


# --- the recursion over Spark's tables -----------------------------------------------------

_BOX = ("bx0", "bx1", "by0", "by1")


def _tile(value: Column, finer: int = 0) -> Column:
    return F.floor(value / F.lit(BASE_TILE / 2 ** (FAN_BITS * finer))).cast("bigint")


def _counted(points: DataFrame, finer: int = 0) -> DataFrame:
    """(image, tx, ty, n, box) of the points of each tile."""
    return points.groupBy("image", _tile(F.col("x"), finer).alias("tx"), _tile(F.col("y"), finer).alias("ty")).agg(
        F.count("*").alias("n"), F.min("x").alias("bx0"), F.max("x").alias("bx1"), F.min("y").alias("by0"), F.max("y").alias("by1")
    )


def _above(base: DataFrame, levels: int) -> DataFrame:
    """``base`` (image, fk, tx, ty, ...) once for each node above: with the node's k, tx and ty."""
    up = lambda c: F.expr(f"shiftright({c}, cast({FAN_BITS} * (k - fk) as int))").alias(c)
    tiles = base.withColumn("k", F.explode(F.sequence("fk", F.lit(levels))))
    return tiles.select("image", "k", up("tx"), up("ty"), *[c for c in tiles.columns if c not in ("image", "k", "tx", "ty")])


def _nodes(base: DataFrame, levels: int) -> DataFrame:
    """All nodes of the quadtree: (image, k, tx, ty, n, box), from counts per smallest tile."""
    return (
        _above(base, levels)
        .groupBy("image", "k", "tx", "ty")
        .agg(F.sum("n").alias("n"), F.min("bx0").alias("bx0"), F.max("bx1").alias("bx1"), F.min("by0").alias("by0"), F.max("by1").alias("by1"))
    )


def _gap(a: str, b: str) -> Column:
    """The square of the distance of two boxes, with column prefixes ``a`` and ``b``."""
    dx = F.greatest(F.lit(0.0), F.col(f"{a}bx0") - F.col(f"{b}bx1"), F.col(f"{b}bx0") - F.col(f"{a}bx1"))
    dy = F.greatest(F.lit(0.0), F.col(f"{a}by0") - F.col(f"{b}by1"), F.col(f"{b}by0") - F.col(f"{a}by1"))
    return dx * dx + dy * dy


def _prefixed(nodes: DataFrame, p: str) -> DataFrame:
    return nodes.select(*[F.col(c).alias(c if c == "image" else p + c) for c in nodes.columns])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _placed(points: DataFrame, fk: int, finer: int = 0) -> DataFrame:
    """Points with their smallest tile: its level ``fk`` and its place."""
    return points.withColumns({"fk": F.lit(fk), "_tx": _tile(F.col("x"), finer), "_ty": _tile(F.col("y"), finer)})


class _QuadTree:
    """The nodes of the upper tree that the recursion may reach, from the roots to the leaves."""

    def __init__(self, points: DataFrame, leaf_points: int, distance: float) -> None:
        counted = checkpointed(_counted(points))
        far, most = counted.agg(F.max(F.greatest(*[F.abs(c) for c in _BOX])), F.max("n")).first()
        self.levels = max(1, math.ceil(math.log2(max(far or 1.0, BASE_TILE) * 1.001 / BASE_TILE) / FAN_BITS))
        # The level of tiles of BASE_TILE; those below it are in hot tiles only.
        fine = 0
        if (most or 0) <= leaf_points:
            self.points, base = _placed(points, 0), counted.withColumn("fk", F.lit(0))
        else:
            if distance >= 0:
                fine = min(MOST_FINE, max(0, math.floor(math.log2(2 * BASE_TILE / distance) / FAN_BITS))) if distance else MOST_FINE
            is_hot, tile = F.col("n") > leaf_points, ["image", "_tx", "_ty"]
            hot = counted.where(is_hot).select("image", F.col("tx").alias("_tx"), F.col("ty").alias("_ty"))
            placed = _placed(points, fine)
            once = placed.join(hot, tile, "left_semi").groupBy("image", "id", "x", "y").agg(F.count("*").alias("_n")).drop("_n")
            once = checkpointed(once)
            self.points = placed.join(hot, tile, "left_anti").unionByName(_placed(once, 0, fine))
            base = counted.where(~is_hot).withColumn("fk", F.lit(fine)).unionByName(_counted(once, fine).withColumn("fk", F.lit(0)))
        self.levels, self.fine = self.levels + fine, fine
        self.base = base = checkpointed(base)
        all_nodes = checkpointed(_nodes(base, self.levels))
        level = all_nodes.where(F.col("k") == self.levels).withColumn("leaf", F.col("n") <= leaf_points)
        alive = [level]
        for k in range(self.levels - 1, -1, -1):
            parent = level.where(~F.col("leaf")).select("image", F.col("tx").alias("_px"), F.col("ty").alias("_py"))
            here = all_nodes.where(F.col("k") == k).withColumn("_px", F.shiftright("tx", FAN_BITS)).withColumn("_py", F.shiftright("ty", FAN_BITS))
            level = here.join(parent, ["image", "_px", "_py"]).drop("_px", "_py")
            level = level.withColumn("leaf", (F.col("n") <= leaf_points) | F.lit(k == 0))
            alive.append(level)
        blocks = F.when(F.col("n") > leaf_points, F.ceil(F.col("n") / min(leaf_points, BLOCK_POINTS))).otherwise(1)
        self.alive = checkpointed(_union(alive).withColumn("blocks", blocks.cast("int")))
        self.leaves = self.alive.where("leaf").drop("leaf")

    def at(self, k: int) -> DataFrame:
        return self.alive.where(F.col("k") == k)

    def below(self, k: int) -> DataFrame:
        """Under the key (image, k, tx, ty) of a node at level k: its children; of a higher leaf: itself."""
        up = self.at(k - 1)
        children = up.select(
            "image", F.lit(k).alias("pk"), F.shiftright("tx", FAN_BITS).alias("px"), F.shiftright("ty", FAN_BITS).alias("py"),
            *[c for c in up.columns if c != "image"],
        )
        same = self.alive.where((F.col("k") >= k) & F.col("leaf"))
        same = same.select("image", F.col("k").alias("pk"), F.col("tx").alias("px"), F.col("ty").alias("py"), *[c for c in up.columns if c != "image"])
        return children.unionByName(same)

    def leaf_pairs(self, distance: float) -> DataFrame:
        """Pairs of leaves whose boxes are at most ``distance`` apart, each once, with themselves too."""
        limit = F.lit(distance * distance)
        reach = max(1, math.ceil(distance / (BASE_TILE * 2 ** (FAN_BITS * (self.levels - self.fine)))))
        steps = F.array(*[F.lit(i) for i in range(-reach, reach + 1)])
        roots = self.at(self.levels)
        moved = _prefixed(roots, "a_").withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
        moved = moved.withColumn("b_tx", F.col("a_tx") + F.col("_dx")).withColumn("b_ty", F.col("a_ty") + F.col("_dy")).drop("_dx", "_dy")
        pairs = moved.join(_prefixed(roots, "b_"), ["image", "b_tx", "b_ty"])
        pairs = pairs.where((F.struct("a_tx", "a_ty") <= F.struct("b_tx", "b_ty")) & (_gap("a_", "b_") <= limit))
        done = []
        for k in range(self.levels, 0, -1):
            pairs = checkpointed(pairs)  # few rows; else each level's plan would hold those above it
            both = F.col("a_leaf") & F.col("b_leaf")
            done.append(pairs.where(both))
            open_ = pairs.where(~both).select(
                "image", *[F.col(f"{p}_{c}").alias(f"{q}{c}") for p, q in (("a", "u"), ("b", "v")) for c in ("k", "tx", "ty")],
                F.struct("a_k", "a_tx", "a_ty").eqNullSafe(F.struct("b_k", "b_tx", "b_ty")).alias("_self"),
            )
            below = self.below(k)
            a = _prefixed(below, "a_").withColumnsRenamed({"a_pk": "uk", "a_px": "utx", "a_py": "uty"})
            b = _prefixed(below, "b_").withColumnsRenamed({"b_pk": "vk", "b_px": "vtx", "b_py": "vty"})
            pairs = open_.join(a, ["image", "uk", "utx", "uty"]).join(b, ["image", "vk", "vtx", "vty"])
            once = ~F.col("_self") | (F.struct("a_tx", "a_ty") <= F.struct("b_tx", "b_ty"))
            pairs = pairs.where(once & (_gap("a_", "b_") <= limit)).drop("_self", "uk", "utx", "uty", "vk", "vtx", "vty")
        return checkpointed(_union([*done, pairs]))

    def leaf_shapes(self, shapes: DataFrame) -> DataFrame:
        """(leaf, shape) for shapes, themselves leaves with a box, whose box meets the leaf's."""
        here = _prefixed(shapes, "s_")
        pairs = here.join(_prefixed(self.at(self.levels), "a_"), "image").where(_gap("s_", "a_") <= 0)
        done = []
        for k in range(self.levels, 0, -1):
            pairs = checkpointed(pairs)
            done.append(pairs.where("a_leaf"))
            open_ = pairs.where(~F.col("a_leaf")).select(
                "image", *[c for c in here.columns if c != "image"], F.col("a_k").alias("uk"), F.col("a_tx").alias("utx"), F.col("a_ty").alias("uty")
            )
            a = _prefixed(self.below(k), "a_").withColumnsRenamed({"a_pk": "uk", "a_px": "utx", "a_py": "uty"})
            pairs = open_.join(a, ["image", "uk", "utx", "uty"]).where(_gap("s_", "a_") <= 0).drop("uk", "utx", "uty")
        return _union([*done, pairs])


#: A task of two blocks names the second one in ``pair``.
_LEAF = ["image", "k", "tx", "ty"]
_TASK = ("image", "k", "tx", "ty", "block", "pair")
_TARGET = "array<struct<k:int,tx:bigint,ty:bigint,blocks:int,bx0:double,bx1:double,by0:double,by1:double,role:int>>"
#: What a point does for a leaf it may be near to: it goes to the leaf's own task, or, where
#: one of both is cut into blocks, to tasks of pairs of blocks as a point of the first or second.
_TO_LEAF, _FIRST, _SECOND = 0, 1, 2


def _point_rows(tree: _QuadTree, distance: float) -> DataFrame:
    """Each point as a row of the task of its leaf, and of tasks of leaves it may be near to."""
    # Under each smallest tile: its leaf, and the leaves that its points may be near to.
    tile = ["image", "fk", "_tx", "_ty"]
    tiles = _above(tree.base.drop("n").withColumns({"_tx": F.col("tx"), "_ty": F.col("ty")}), tree.levels)
    leaf = tiles.join(tree.leaves.select("image", "k", "tx", "ty", "blocks"), ["image", "k", "tx", "ty"])
    limit = max(distance, 0.0) ** 2
    if distance < 0:  # no point is near another one
        tiles = leaf.drop(*_BOX).withColumn("to", F.lit(None).cast(_TARGET))
    else:
        pairs = checkpointed(tree.leaf_pairs(distance))
        apart = pairs.where(~F.struct("a_k", "a_tx", "a_ty").eqNullSafe(F.struct("b_k", "b_tx", "b_ty")))
        whole = (F.col("a_blocks") == 1) & (F.col("b_blocks") == 1)
        smaller = F.col("a_k") <= F.col("b_k")

        def sent(rows: DataFrame, p: str, q: str, role: int) -> DataFrame:
            """For the leaf ``p``: its target ``q``."""
            target = F.struct(*[F.col(f"{q}_{c}").alias(c) for c in ("k", "tx", "ty", "blocks", *_BOX)], F.lit(role).alias("role"))
            return rows.select("image", *[F.col(f"{p}_{c}").alias(c) for c in ("k", "tx", "ty")], target.alias("to"))

        targets = sent(apart.where(whole & smaller), "b", "a", _TO_LEAF).unionByName(sent(apart.where(whole & ~smaller), "a", "b", _TO_LEAF))
        targets = targets.unionByName(sent(apart.where(~whole), "a", "b", _FIRST)).unionByName(sent(apart.where(~whole), "b", "a", _SECOND))
        reach = leaf.join(targets, ["image", "k", "tx", "ty"]).withColumns({f"t{c}": F.col(f"to.{c}") for c in _BOX})
        reach = reach.where(_gap("", "t") <= limit).groupBy(*tile).agg(F.collect_list("to").alias("to"))
        tiles = leaf.drop(*_BOX).join(reach, tile, "left")

    placed = tree.points.join(tiles, tile)
    placed = placed.withColumn("_block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("id"), F.col("blocks"))).otherwise(0).cast("int"))
    block, none = F.col("_block"), F.lit(None).cast("string")
    name = lambda k, tx, ty, block: F.concat_ws("/", k, tx, ty, block)

    def at(k: Column, tx: Column, ty: Column, block: Column, kind: Column, pair: Column) -> Column:
        return F.struct(
            k.alias("k"), tx.alias("tx"), ty.alias("ty"), block.cast("int").alias("block"), kind.cast("tinyint").alias("kind"), pair.alias("pair")
        )

    x, y, here = F.col("x"), F.col("y"), (F.col("k"), F.col("tx"), F.col("ty"))
    dx = lambda t: F.greatest(F.lit(0.0), t["bx0"] - x, x - t["bx1"])
    dy = lambda t: F.greatest(F.lit(0.0), t["by0"] - y, y - t["by1"])
    point, halo = F.lit(_POINT), F.lit(_HALO)
    own = F.array(at(*here, block, point, none))
    blocks_but_own = F.when(
        (F.col("blocks") > 1) & F.lit(distance >= 0),
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i != block),
            lambda i: at(*here, F.least(i, block), F.when(block < i, point).otherwise(halo), name(*here, F.greatest(i, block))),
        ),
    )
    near = F.filter("to", lambda t: dx(t) * dx(t) + dy(t) * dy(t) <= limit)

    def task(t: Column, i: Column) -> Column:
        first, there = t["role"] == _FIRST, (t["k"], t["tx"], t["ty"])
        of = lambda c: F.when(first, F.col(c)).otherwise(t[c])
        pair = F.when(first, name(*there, i)).when(t["role"] == _SECOND, name(*here, block))
        return at(of("k"), of("tx"), of("ty"), F.when(first, block).otherwise(i), F.when(first, point).otherwise(halo), pair)

    other = F.flatten(F.transform(near, lambda t: F.transform(F.sequence(F.lit(0), t["blocks"] - 1), lambda i: task(t, i))))
    nothing = F.array().cast("array<struct<k:int,tx:bigint,ty:bigint,block:int,kind:tinyint,pair:string>>")
    tasks = F.concat(own, F.coalesce(blocks_but_own, nothing), F.coalesce(other, nothing))
    empty = F.lit(None).cast("double")
    return placed.select("image", "id", "x", "y", F.explode(tasks).alias("t")).select(
        "image", "t.k", "t.tx", "t.ty", "t.block", "t.pair", "t.kind", "id", "x", "y", empty.alias("x2"), empty.alias("y2"), F.lit(None).cast("int").alias("ring")
    )


def _edge_rows(shapes: DataFrame, tree: _QuadTree) -> tuple[DataFrame, DataFrame]:
    """Each edge of a shape with the leaves whose points it may enclose; and how many edges a leaf's shapes have at most."""
    point_ok = lambda p: p.isNotNull() & p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"])
    once = shapes.groupBy("image", "id").agg(F.min("rings").alias("rings"))  # a repeated row counts once
    rings = once.where(F.col("image").isNotNull() & (F.size("rings") > 0) & (F.size(F.get("rings", F.lit(0))) >= 3))
    size = F.aggregate("rings", F.lit(0), lambda n, r: n + F.coalesce(F.size(r), F.lit(0))).alias("edges")
    rings = rings.select("image", "id", size, F.posexplode("rings").alias("ring", "points"))
    rings = rings.select("image", "id", "edges", "ring", F.filter("points", point_ok).alias("p")).where(F.size("p") >= 3)
    ends = F.concat(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), F.slice("p", 1, 1))
    edges = rings.select("image", "id", "ring", F.explode(F.arrays_zip(F.col("p").alias("f"), ends.alias("t"))).alias("e"))
    edges = edges.select(
        "image", "id", "ring", F.col("e.f.x").alias("x"), F.col("e.f.y").alias("y"), F.col("e.t.x").alias("x2"), F.col("e.t.y").alias("y2")
    )
    boxes = rings.where("ring = 0").select(
        "image", "id", "edges",
        F.array_min("p.x").alias("bx0"), F.array_max("p.x").alias("bx1"), F.array_min("p.y").alias("by0"), F.array_max("p.y").alias("by1"),
    )
    pairs = checkpointed(tree.leaf_shapes(boxes).select(
        "image", F.col("s_id").alias("id"), F.col("s_edges").alias("edges"), F.col("a_k").alias("k"), F.col("a_tx").alias("tx"), F.col("a_ty").alias("ty"), "a_blocks", *[f"a_{c}" for c in _BOX]
    ))
    # A ray to the right of a leaf's points meets only edges of their height and not left of them.
    met = (F.greatest("y", "y2") >= F.col("a_by0")) & (F.least("y", "y2") <= F.col("a_by1")) & (F.greatest("x", "x2") >= F.col("a_bx0"))
    rows = edges.join(pairs.drop("edges"), ["image", "id"]).where(met).select("image", "k", "tx", "ty", "a_blocks", "id", "x", "y", "x2", "y2", "ring")
    return rows, pairs.groupBy(*_LEAF).agg(F.sum("edges").alias("edges"))


def _with_block(rows: DataFrame, pair: Column) -> DataFrame:
    """Edges as rows of the tasks of each block of their leaf."""
    return rows.select(
        *_LEAF, F.explode(F.sequence(F.lit(0), F.col("a_blocks") - 1)).alias("block"), pair.alias("pair"),
        F.lit(_EDGE).cast("tinyint").alias("kind"), "id", "x", "y", "x2", "y2", "ring",
    )


def _within_many_edges(points: DataFrame, rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``shape`` rows of the leaves whose edges are cut into ``parts``: crossings are counted per part, then added."""
    name = lambda part: F.concat(F.lit("e"), part)
    cut = rows.join(parts, _LEAF)
    edges = _with_block(cut, name(F.pmod(F.xxhash64("id", "ring", "x", "y", "x2", "y2"), F.col("parts"))))
    own = points.where(F.col("pair").isNull() & (F.col("kind") == _POINT)).join(parts, _LEAF)
    own = own.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("pair", name(F.col("_part"))).drop("parts", "_part")
    odd = own.unionByName(edges).groupBy(*_TASK).applyInArrow(_odd_in, "image string, id_a bigint, id_b bigint, ring int")
    odd = odd.groupBy("image", "id_a", "id_b", "ring").agg(F.count("*").alias("n")).where("n % 2 = 1")
    inside = odd.groupBy("image", "id_a", "id_b").agg(F.min("ring").alias("first"), F.count("*").alias("n")).where("first = 0 and n = 1")
    return inside.select("image", F.lit("shape").alias("near_kind"), "id_a", "id_b")


def near(points: DataFrame, shapes: DataFrame | None = None, distance: float = 4.0, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """(image, near_kind, id_a, id_b): what each point is near to or within.

    ``points`` has image, id, x, y; ``shapes`` has image, id, rings. ``cell`` rows are pairs of
    different ids of one image at most ``distance`` apart, id_a < id_b; ``shape`` rows are a
    point's id and the id of a shape with the point inside its first ring and inside none of
    its others. A negative distance leaves the first kind out.

    A NULL image or id and a NULL, NaN or infinite coordinate give no row. A point given again
    at its place counts once. A shape without rings, or whose first ring has fewer than three
    points, gives none; other rings of fewer than three points enclose nothing. Rings may be
    closed or not and run either way. Empty tables give no row; other columns are ignored.
    """
    fine = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    points = points.select("image", F.col("id").cast("bigint").alias("id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    points = points.where(F.col("image").isNotNull() & F.col("id").isNotNull() & fine("x") & fine("y"))
    tree = _QuadTree(points, leaf_points, distance)
    found = "image string, near_kind string, id_a bigint, id_b bigint"
    rows = _point_rows(tree, distance)
    if shapes is None:
        return rows.groupBy(*_TASK).applyInArrow(_task(distance), found)
    edges, most = _edge_rows(shapes.select("image", F.col("id").cast("bigint").alias("id"), "rings"), tree)
    crowded = most.where(F.col("edges") > leaf_points).select(*_LEAF)
    few, none = edges, F.lit(None).cast("string")
    parts = None
    if not crowded.isEmpty():
        many = edges.join(crowded, _LEAF, "left_semi").groupBy(*_LEAF).agg(F.count("*").alias("n")).where(F.col("n") > leaf_points)
        parts = checkpointed(many.select(*_LEAF, F.ceil(F.col("n") / leaf_points).cast("int").alias("parts")))
        few = edges.join(parts, _LEAF, "left_anti")
    near_found = rows.unionByName(_with_block(few, none)).groupBy(*_TASK).applyInArrow(_task(distance), found)
    return near_found if parts is None else near_found.unionByName(_within_many_edges(rows, edges, parts))


def cells_near(cells: DataFrame, shapes: DataFrame, distance: float = 4.0) -> DataFrame:
    """:func:`near` over a cell table (image, cellID, x_px, y_px) and a shape table (shape_id, image, rings)."""
    points = cells.select("image", F.col("cellID").alias("id"), F.col("x_px").alias("x"), F.col("y_px").alias("y"))
    return near(points, shapes.select("image", F.col("shape_id").alias("id"), "rings"), distance)
