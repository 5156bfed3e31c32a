"""Distance joins on bins, one-to-one matching and chance rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from slideloom.session import checkpointed

#: Candidates per reference that matching looks at.
CANDIDATES = 3


def _bin(value: Column, size: float) -> Column:
    return F.floor(value / F.lit(float(size))).cast("bigint")


def within(a: DataFrame, b: DataFrame, radius: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, a, b, d): pairs of points (id, x, y) at most ``radius`` apart.

    Points meet on bins as wide as the radius; one side is laid out on the 3 x 3 bins around
    it. NULL and NaN coordinates meet nothing.
    """
    ok = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    shifts = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    p = a.where(ok).select(*keys, F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    p = p.withColumn("_bx", F.explode(shifts)).withColumn("_by", F.explode(shifts))
    p = p.withColumn("_bx", F.col("_bx") + _bin(F.col("ax"), radius)).withColumn("_by", F.col("_by") + _bin(F.col("ay"), radius))
    q = b.where(ok).select(*keys, F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
    q = q.withColumn("_bx", _bin(F.col("bx"), radius)).withColumn("_by", _bin(F.col("by"), radius))
    d2 = (F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2
    return p.join(q, [*keys, "_bx", "_by"]).where(d2 <= radius * radius).select(*keys, "a", "b", F.sqrt(d2).alias("d"))


def neighbours(points: DataFrame, radius: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, id, neighbours): how many other points lie within the radius of each point."""
    pairs = within(points, points, radius, keys).where("a <> b").groupBy(*keys, F.col("a").alias("id")).agg(F.count("*").alias("neighbours"))
    return points.select(*keys, "id").join(pairs, [*keys, "id"], "left").withColumn("neighbours", F.coalesce("neighbours", F.lit(0)))


def nearest(ref: DataFrame, ours: DataFrame, k: int, radius: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, ref, ours, d, rank): the k nearest of ours to each reference within the radius; ties by id."""
    pairs = within(ref, ours, radius, keys).select(*keys, F.col("a").alias("ref"), F.col("b").alias("ours"), "d")
    rank = F.row_number().over(Window.partitionBy(*keys, "ref").orderBy("d", "ours"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def matched(ref: DataFrame, ours: DataFrame, radius: float, keys: Sequence[str] = (), candidates: int = CANDIDATES) -> DataFrame:
    """(keys, ref, ours, d): greedy one-to-one matches, nearest pairs first, ties by (ref, ours).

    Rounds of mutually best pairs give what the sequential order gives; only the nearest
    ``candidates`` of each reference take part, so a reference may stay without a match.
    """
    edges = checkpointed(nearest(ref, ours, candidates, radius, keys).drop("rank"))
    order = ["d", "ref", "ours"]
    done: DataFrame | None = None
    while True:  # the nearest pair left is always taken
        first = lambda end: F.row_number().over(Window.partitionBy(*keys, end).orderBy(*order))
        best = checkpointed(edges.withColumn("_r", first("ref")).withColumn("_o", first("ours")).where("_r = 1 and _o = 1").drop("_r", "_o"))
        done = best if done is None else done.unionByName(best)
        edges = checkpointed(
            edges.join(best.select(*keys, "ref"), [*keys, "ref"], "left_anti").join(best.select(*keys, "ours"), [*keys, "ours"], "left_anti")
        )
        if edges.isEmpty():
            return done


def chance_rate(ref: DataFrame, ours: DataFrame, radius: float, shifts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, rate): the mean share of references matched after each of ``shifts`` (shift, dx, dy).

    Shifts are few; they are broadcast, and all of them are matched in the same rounds.
    """
    moved = ref.crossJoin(F.broadcast(shifts)).withColumn("x", F.col("x") + F.col("dx")).withColumn("y", F.col("y") + F.col("dy")).drop("dx", "dy")
    theirs = ours.crossJoin(F.broadcast(shifts.select("shift")))
    own = [*keys, "shift"]
    found = matched(moved, theirs, radius, own).groupBy(*own).agg(F.count("*").alias("n"))
    rates = moved.groupBy(*own).agg(F.count("*").alias("all")).join(found, own, "left")
    rates = rates.select(*own, (F.coalesce("n", F.lit(0)) / F.col("all")).alias("rate"))
    return rates.groupBy(*keys).agg(F.round(F.avg("rate"), 6).alias("rate"))


def segments(shapes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, shape_id, ring, x1, y1, x2, y2): the edges of each ring, closed at the end."""
    rings = shapes.select(*keys, "shape_id", F.posexplode("rings").alias("ring", "p")).where(F.size("p") >= 3)
    ends = F.concat(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), F.slice("p", 1, 1))
    zipped = rings.select(*keys, "shape_id", "ring", F.explode(F.arrays_zip(F.col("p").alias("f"), ends.alias("t"))).alias("e"))
    return zipped.select(
        *keys, "shape_id", "ring", F.col("e.f.x").alias("x1"), F.col("e.f.y").alias("y1"), F.col("e.t.x").alias("x2"), F.col("e.t.y").alias("y2")
    )


def edge_distance(x: Column, y: Column) -> Column:
    """The distance of a point from the segment x1, y1, x2, y2 of the row; a point-like segment counts as a point."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length2 = dx * dx + dy * dy
    t = F.when(length2 == 0, F.lit(0.0)).otherwise(((x - F.col("x1")) * dx + (y - F.col("y1")) * dy) / F.when(length2 == 0, F.lit(1.0)).otherwise(length2))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    px, py = F.col("x1") + t * dx - x, F.col("y1") + t * dy - y
    return F.sqrt(px * px + py * py)


def boundary_distance(points: DataFrame, edges: DataFrame, limit: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, id, d): the distance of each point from the nearest edge, for points within ``limit`` of one.

    Edges are laid out on bins as wide as the limit, with a margin of it, and meet points there.
    """
    a = [F.floor((F.least(f"{c}1", f"{c}2") - limit) / limit).cast("bigint") for c in "xy"]
    b = [F.floor((F.greatest(f"{c}1", f"{c}2") + limit) / limit).cast("bigint") for c in "xy"]
    laid = edges.withColumn("_bx", F.explode(F.sequence(a[0], b[0]))).withColumn("_by", F.explode(F.sequence(a[1], b[1])))
    here = points.withColumn("_bx", _bin(F.col("x"), limit)).withColumn("_by", _bin(F.col("y"), limit))
    met = here.join(laid.drop("shape_id", "ring"), [*keys, "_bx", "_by"]).withColumn("d", edge_distance(F.col("x"), F.col("y")))
    return met.where(F.col("d") <= limit).groupBy(*keys, "id").agg(F.min("d").alias("d"))


def ring_centroids(shapes: DataFrame) -> DataFrame:
    """(shape_id, cx, cy): the mean of the vertices of the first ring, a closing one included."""
    first = shapes.where(F.size("rings") > 0).select("shape_id", F.explode(F.get("rings", F.lit(0))).alias("p"))
    return first.groupBy("shape_id").agg(F.round(F.avg("p.x"), 6).alias("cx"), F.round(F.avg("p.y"), 6).alias("cy"))


def shift_votes(ref: DataFrame, ours: DataFrame, reach: float, step: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, dx, dy, votes): how many pairs of points each offset, in steps, brings together.

    Offsets up to ``reach`` are looked at; the pairs come from bins as wide as it.
    """
    b = ours.select(*keys, F.col("id").alias("b"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    a = ref.select(*keys, F.col("id").alias("a"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    pairs = within(ref, ours, reach, keys).join(a, [*keys, "a"]).join(b, [*keys, "b"])
    offset = lambda o, r: F.bround((F.col(o) - F.col(r)) / step).cast("int")
    return pairs.groupBy(*keys, offset("ox", "rx").alias("dx"), offset("oy", "ry").alias("dy")).agg(F.count("*").alias("votes"))


def best_shift(votes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, dx, dy, votes): the offset with most votes; ties by the shortest, then the smallest."""
    key = F.struct("votes", (-F.col("dx") * F.col("dx") - F.col("dy") * F.col("dy")).alias("near"), (-F.col("dx")).alias("a"), (-F.col("dy")).alias("b"))
    return votes.groupBy(*keys).agg(F.max_by(F.struct("dx", "dy", "votes"), key).alias("m")).select(*keys, "m.*")


def point_map(points: DataFrame, size: float, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, by, bx, n): points per square of ``size``."""
    return points.groupBy(*keys, _bin(F.col("y"), size).alias("by"), _bin(F.col("x"), size).alias("bx")).agg(F.count("*").alias("n"))


def found_rate(matches: DataFrame, most: int = 8) -> DataFrame:
    """(neighbours, n, rate): share found by number of neighbours, ``most`` and more as one."""
    return matches.groupBy(F.least("neighbours", F.lit(most)).alias("neighbours")).agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("found").cast("int")), 6).alias("rate")
    )


def crowding(matches: DataFrame) -> DataFrame:
    """(moderate, dense): share found among references with 1 to 3 and with 7 or more neighbours; NULL without any."""
    rate = lambda c: F.round(F.avg(F.when(c, F.col("found").cast("int"))), 6)
    return matches.agg(rate(F.col("neighbours").between(1, 3)).alias("moderate"), rate(F.col("neighbours") >= 7).alias("dense"))


def most_common(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): the value most rows have, the smallest of equally frequent ones; NULL does not count."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value))
    return counts.withColumn("_r", rank).where("_r = 1").drop("_r")
