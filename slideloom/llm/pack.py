"""Filling containers of fixed capacity with items, with as little unused space as possible.

Method: a configuration linear program over the histogram of sizes. Its unknowns are amounts
of patterns (how many items of each size one container takes). It is solved by multiplicative
weights: sizes and patterns each hold weights that are moved against one another, a knapsack
dynamic program prices the best pattern under the averaged weights of the sizes, and the
averages give both a solution and, by duality, a bound that no packing can go below. The
solution is rounded down and what is left over is placed by best fit over the histogram.

Only histograms meet in one task: one row per size up to the capacity, however many items
there are. The items are then numbered within their size in parallel and find their
containers by a join on ranges of those numbers.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, Window, functions as F

from slideloom.session import checkpointed

#: Rounds of pricing, steps of the weights between two of them, and how far a step goes.
ROUNDS = 150
STEPS = 100
RATE = 16.0
#: Share above the bound at which the program counts as solved.
GAP = 0.002
#: Groups of sizes that the program tells apart; with more sizes, those below the share of the
#: capacity are a liquid that fills what room the others leave.
GROUPS = 64
LIQUID_SHARE = 1 / 32
#: Parts in which the items of one size are numbered, and ranges of the join per size.
PARTS = 1024
RANGES = 1024
#: Kinds of containers that are filled in one pass over the items.
BLOCK_KINDS = 64

Pattern = tuple[tuple[int, int], ...]


def price(sizes: np.ndarray, most: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """How many items of each size the pattern of greatest weight holds, and its weight.

    A pattern fits the capacity and holds at most ``most`` items of each size; sizes without
    a positive weight are left out.
    """
    best = np.zeros(capacity + 1)
    parts: list[tuple[int, int, np.ndarray]] = []
    for k in np.flatnonzero((weights > 0) & (most > 0)).tolist():
        size, count, weight = int(sizes[k]), int(most[k]), float(weights[k])
        step = 1
        while count > 0:  # counts are cut into powers of two
            take = min(step, count)
            count -= take
            step *= 2
            room = size * take
            if room > capacity:
                break
            value = best[: capacity + 1 - room] + weight * take
            better = value > best[room:]
            np.maximum(best[room:], value, out=best[room:])
            parts.append((k, take, better))
    held = np.zeros(len(sizes), np.int64)
    at = int(best.argmax())
    weight = float(best[at])
    for k, take, better in reversed(parts):
        room = int(sizes[k]) * take
        if at >= room and better[at - room]:
            held[k] += take
            at -= room
    return held, weight


@dataclass(frozen=True)
class Program:
    """The configuration program of a histogram, over groups of sizes of about equal volume.

    A pattern takes the largest size of a group for each of its items, so that it always fits.
    What it covers of the liquid is the room it leaves beside items of mean size.
    """

    group: np.ndarray
    top: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    liquid: float
    capacity: int
    area: float

    @classmethod
    def of(cls, sizes: np.ndarray, counts: np.ndarray, capacity: int) -> Program:
        """``sizes`` ascending; a size of the liquid has group -1."""
        many = len(sizes) > GROUPS
        volume = sizes * counts.astype(float)
        wet = (sizes <= capacity * LIQUID_SHARE) & many
        below = np.cumsum(np.where(wet, 0.0, volume))
        group = np.arange(len(sizes))
        if many:
            group = np.minimum((below - volume / 2) * GROUPS / max(1.0, below[-1]), GROUPS - 1).astype(int)
        _, group[~wet] = np.unique(group[~wet], return_inverse=True)
        group[wet] = -1
        k = group.max(initial=-1) + 1
        n = np.bincount(group[~wet], counts[~wet], k)
        top = np.zeros(k, np.int64)
        np.maximum.at(top, group[~wet], sizes[~wet])
        return cls(group, top, n, np.bincount(group[~wet], volume[~wet], k) / n, float(volume[wet].sum()), capacity, float(volume.sum()) / capacity)

    def covered(self, held: np.ndarray) -> np.ndarray:
        """What a pattern covers of each group, and of the liquid if there is any, times the least number of containers."""
        share = held / self.n
        if self.liquid:
            share = np.append(share, max(0.0, self.capacity - float(held @ self.mean)) / self.liquid)
        return share * self.area

    def best(self, p: np.ndarray) -> tuple[np.ndarray, float]:
        """The pattern that covers most under weights ``p``, and how much."""
        wet = p[-1] / self.liquid if self.liquid else 0.0
        most = np.minimum(self.n, self.capacity // self.top).astype(np.int64)
        held, weight = price(self.top, most, p[: len(self.n)] / self.n - wet * self.mean, self.capacity)
        return held, (weight + wet * self.capacity) * self.area


@dataclass(frozen=True)
class Solution:
    """Amounts of patterns (items per group), their total, and weights per group from which a bound follows."""

    program: Program
    patterns: list[np.ndarray]
    amounts: np.ndarray
    total: float
    weights: np.ndarray


def fractional(sizes: np.ndarray, counts: np.ndarray, capacity: int, fitted: int, rounds: int = ROUNDS, gap: float = GAP) -> Solution:
    """The program solved by multiplicative weights, from ``fitted`` containers that best fit takes.

    The sizes' weights p fall with what the patterns' weights q cover of them, q rise with
    what they cover under p. Each round prices one more pattern under p, then moves both for
    STEPS steps and takes the averages. q scaled to cover everything is a solution; the area
    over the greatest cover of any pattern under p is a bound of the program. Best fit's whole
    packing is the first pattern, so the solution never needs more. The end is a gap of
    ``gap``, or ``rounds``.
    """
    program = Program.of(sizes, counts, capacity)
    area = program.area
    p = np.append(program.n * program.mean, program.liquid) if program.liquid else program.n * program.mean
    p = kept = p / p.sum()
    q = np.ones(1)
    held: list[np.ndarray] = []
    covers = [np.full(len(p), area / fitted)]
    total, bound, amounts = float(fitted), 0.0, np.array([float(fitted)])
    for _ in range(rounds):
        pattern, most = program.best(p)
        if area / most > bound:
            bound, kept = area / most, p
        if total <= bound * (1 + gap):
            break
        if not any((pattern == h).all() for h in held):
            held.append(pattern)
            covers.append(program.covered(pattern))
            q = np.append(q * 0.98, 0.02)
        a = np.array(covers)
        rate = RATE / a.max()
        p, q = np.maximum(p, 1e-7), np.maximum(q, 1e-7)
        p, q = p / p.sum(), q / q.sum()
        last_p, last_q, sum_p, sum_q = q @ a, a @ p, np.zeros(len(p)), np.zeros(len(q))
        for _ in range(STEPS):
            now_p, now_q = q @ a, a @ p
            p = p * np.exp(-rate * (2 * now_p - last_p))
            q = q * np.exp(rate * (2 * now_q - last_q))
            p, q = p / p.sum(), q / q.sum()
            last_p, last_q = now_p, now_q
            sum_p += p
            sum_q += q
        q = max(q, sum_q / STEPS, key=lambda v: (v @ a).min())
        p = min(p, sum_p / STEPS, key=lambda v: (a @ v).max())
        if area / (q @ a).min() < total:
            total = area / (q @ a).min()
            amounts = q * total
    return Solution(program, held[: len(amounts) - 1], amounts[1:], total, kept)


def least(sizes: np.ndarray, counts: np.ndarray, capacity: int, solution: Solution) -> float:
    """Containers that any packing needs at least: the best of some dual solutions over all sizes.

    Each gives every size a value; if no pattern holds more than v, the items' values over v
    are a bound. The values are the sizes themselves; the solution's weights, between the
    largest sizes of the groups, of the size's own group, and of the group below; and, for
    each cut, 1 for sizes that leave less than the cut, 0 for sizes below it.
    """
    program = solution.program
    groups = len(program.top)
    wet = solution.weights[-1] / program.liquid if program.liquid else 0.0
    edge = capacity * LIQUID_SHARE if program.liquid else 0.0
    weights = np.append(edge * wet, solution.weights[:groups] / program.n)
    dry = sizes > edge
    own = np.where(dry, program.group, 0)
    bounds = [program.area]
    for values in (np.interp(sizes, np.append(edge, program.top), weights), weights[own + 1], weights[own]):
        values = np.where(dry, values, sizes * wet)
        most = price(sizes, np.minimum(counts, capacity // sizes), values, capacity)[1]
        if most > 0:
            bounds.append(float(values @ counts) / most)
    # Of two sizes above the half none share a container; what room they leave is open to sizes from the cut on.
    half = sizes > capacity / 2
    items, volume = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(sizes * counts))
    middle = np.searchsorted(sizes, capacity / 2, side="right")
    low = sizes[~half]
    above = np.searchsorted(sizes, capacity - low, side="right")  # those that leave less than the cut
    room = (items[above] - items[middle]) * capacity - (volume[above] - volume[middle])
    between = volume[middle] - volume[: len(low)]
    bounds.append(float(items[-1] - items[middle]) + max(0.0, float(((between - room) / capacity).max(initial=0.0))))
    return max(bounds)


def best_fit(left: Counter[int], bins: list[tuple[int, int, Pattern]], capacity: int) -> list[tuple[int, Pattern]]:
    """Places the items left over, largest first, each where least room remains.

    ``bins`` are (room, how many, pattern); alike bins are handled together, so that the
    work follows the number of different sizes and rooms.
    """
    groups: dict[int, list[tuple[int, Pattern]]] = {}
    for room, many, pattern in bins:
        groups.setdefault(room, []).append((many, pattern))
    rooms = sorted(groups)

    def put(room: int, many: int, pattern: Pattern) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((many, pattern))

    for size in sorted(left, reverse=True):
        count = left[size]
        while count > 0:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = min(count, capacity // size)
                many = count // each
                put(capacity - each * size, many, ((size, each),))
                count -= many * each
                continue
            room = rooms[at]
            many, pattern = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            each = min(room // size, count)
            used = min(many, count // each)
            if used < many:
                put(room, many - used, pattern)
            put(room - each * size, used, (*pattern, (size, each)))
            count -= used * each
    return [(many, pattern) for of in groups.values() for many, pattern in of]


def _rounded(sizes: np.ndarray, counts: np.ndarray, solution: Solution) -> tuple[Counter[int], list[tuple[int, int, Pattern]]]:
    """(items left over, (room, how many, pattern)) of the solution's whole containers.

    The items of a group are dealt out from the largest on; containers of one pattern whose
    items differ in size are told apart.
    """
    program = solution.program
    stock = {}
    for g in range(len(program.n)):
        own = np.flatnonzero(program.group == g)[::-1]
        stock[g] = [[int(sizes[k]), int(counts[k])] for k in own][::-1]  # the largest is last
    has = {g: sum(c for _, c in s) for g, s in stock.items()}
    bins = []
    for k in np.argsort(-solution.amounts, kind="stable"):
        pattern = [(g, int(a)) for g, a in enumerate(solution.patterns[k]) if a]
        many = min([math.floor(solution.amounts[k] + 1e-6), *(has[g] // a for g, a in pattern)])
        if many < 1 or not pattern:
            continue
        slots = []
        for g, a in pattern:
            has[g] -= a * many
            for _ in range(a):
                runs, need = [], many
                while need:
                    size, count = stock[g][-1]
                    take = min(count, need)
                    runs.append((size, take))
                    need -= take
                    stock[g][-1][1] -= take
                    if take == count:
                        stock[g].pop()
                slots.append(runs)
        ends = sorted({e for runs in slots for e in np.cumsum([c for _, c in runs]).tolist()})
        at = 0
        for end in ends:
            items: Counter[int] = Counter()
            for runs in slots:
                past = 0
                for size, count in runs:
                    past += count
                    if past >= end:
                        items[size] += 1
                        break
            bins.append((program.capacity - sum(s * a for s, a in items.items()), end - at, tuple(sorted(items.items(), reverse=True))))
            at = end
    left = Counter({s: c for own in stock.values() for s, c in own if c})
    left.update({int(s): int(c) for s, c in zip(sizes[program.group < 0], counts[program.group < 0])})
    return left, bins


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[int, Pattern]], int]:
    """((how many containers, pattern) that hold exactly the items of a histogram, the least number of containers).

    Where rounding has cost more than the program gained, best fit's own packing is given.
    """
    order = np.argsort(sizes)
    sizes, counts = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    found = best_fit(Counter(dict(zip(sizes.tolist(), counts.tolist()))), [], capacity)
    fitted = sum(many for many, _ in found)
    solution = fractional(sizes, counts, capacity, fitted)
    bound = math.ceil(solution.program.area - 1e-9)
    if fitted > bound:
        bound = max(bound, math.ceil(least(sizes, counts, capacity, solution) - 1e-6))
    if solution.patterns:
        rounded = best_fit(*_rounded(sizes, counts, solution), capacity)
        found = min(rounded, found, key=lambda f: sum(many for many, _ in f))
    return found, bound


_PLAN = "container_kind string, size int, first_rank bigint, last_rank bigint, n bigint, per_container int, first_container bigint, least bigint"


def _plan(histogram: pd.DataFrame) -> pd.DataFrame:
    kind, capacity = histogram["container_kind"].iloc[0], int(histogram["capacity"].iloc[0])
    sizes, counts = histogram["size"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64)
    n = dict(zip(sizes.tolist(), counts.tolist()))
    ranks: Counter[int] = Counter()
    container, rows = 0, []
    found, bound = solve(sizes, counts, capacity)
    for many, pattern in found:
        merged: Counter[int] = Counter()
        for size, each in pattern:
            merged[size] += each
        for size, each in merged.items():
            rows.append((kind, size, ranks[size], ranks[size] + many * each, n[size], each, container, bound))
            ranks[size] += many * each
        container += many
    return pd.DataFrame(rows, columns=["container_kind", "size", "first_rank", "last_rank", "n", "per_container", "first_container", "least"])


def _blocks(kinds: DataFrame) -> Iterator[list[Row]]:
    rows = kinds.where("container_kind is not null and capacity_tokens > 0").select("container_kind", "capacity_tokens").toLocalIterator()
    while block := list(islice(rows, BLOCK_KINDS)):
        yield block


def placed(sizes: DataFrame, kinds: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of :func:`pack`, with the least number of containers that their kind needs (``least``)."""
    blocks = [_placed(sizes, [(r[0], int(r[1])) for r in block], key) for block in _blocks(kinds)]
    return reduce(DataFrame.unionByName, blocks) if blocks else _placed(sizes, [("", 0)], key)


def _placed(sizes: DataFrame, wanted: list[tuple[str, int]], key: str) -> DataFrame:
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).alias("capacity")) for k, c in wanted])).alias("k")
    items = sizes.select(F.col(key), F.col("size").cast("int").alias("whole")).where("whole > 0").withColumn("nth", F.monotonically_increasing_id())
    items = items.select(key, "nth", "whole", kind).select(key, "nth", "whole", "k.*").where("capacity > 0")
    part = F.explode(F.sequence(F.lit(0), F.expr("(whole - 1) div capacity").cast("int"))).alias("part")
    parts = items.select(key, "nth", "whole", "container_kind", "capacity", part)
    parts = parts.withColumn("start", F.col("part") * F.col("capacity"))
    parts = checkpointed(parts.withColumn("size", F.least("capacity", F.col("whole") - F.col("start"))).withColumn("slot", F.pmod(F.xxhash64("nth", "part"), F.lit(PARTS)).cast("int")).drop("whole"))

    by_slot = checkpointed(parts.groupBy("container_kind", "capacity", "size", "slot").agg(F.count("*").alias("k")))
    histogram = by_slot.groupBy("container_kind", "capacity", "size").agg(F.sum("k").alias("n"))
    # One task per kind: a given number of partitions is not coalesced.
    plan = checkpointed(histogram.repartition(4 * len(wanted), "container_kind").groupBy("container_kind").applyInPandas(_plan, _PLAN))
    before = Window.partitionBy("container_kind", "size").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_slot.select(
        "container_kind", "size", "slot", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"), F.sum("k").over(Window.partitionBy("container_kind", "size")).alias("n")
    )

    # The number of an item within its size, counted in parallel: offset of its slot + place in it.
    # A size has RANGES ranges of numbers, however many items it has.
    place = Window.partitionBy("container_kind", "size", "slot").orderBy("nth", "part")
    numbered = parts.withColumn("place", F.row_number().over(place) - 1).join(offsets, ["container_kind", "size", "slot"])
    width = f"((n - 1) div {RANGES} + 1)"
    numbered = numbered.withColumn("rank", F.col("offset") + F.col("place")).withColumn("range", F.expr(f"rank div {width}"))
    ranges = plan.withColumn("range", F.explode(F.sequence(F.expr(f"first_rank div {width}"), F.expr(f"(last_rank - 1) div {width}")))).drop("n")
    found = numbered.join(ranges, ["container_kind", "size", "range"]).where("rank >= first_rank and rank < last_rank")
    container = F.col("first_container") + F.expr("(rank - first_rank) div per_container")
    return found.select(
        "container_kind", container.alias("container"), key, "part", F.col("start").cast("int").alias("start"), F.col("size").cast("int").alias("size"), "capacity", "least"
    )


def pack(sizes: DataFrame, kinds: DataFrame, key: str = "doc_id") -> DataFrame:
    """(container_kind, container, key, part, start, size): the place of every item.

    ``sizes`` has key and size; ``kinds`` has container_kind and capacity_tokens, one row per
    kind; kinds are filled BLOCK_KINDS at a time. Items of NULL or no size are left out. An
    item larger than the capacity is cut into parts from the front: full ones, which each fill
    a container, and the rest; ``start`` is where a part begins. No other item is cut.
    Containers are numbered from 0 within their kind. Repeated rows are items of their own; a
    kind without a name or capacity takes nothing; empty tables give no row.
    """
    return placed(sizes, kinds, key).drop("capacity", "least")


def usage(sizes: DataFrame, kinds: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per kind: containers used, the least that any packing needs, the gap, tokens and unused share."""
    total = placed(sizes, kinds, key).groupBy("container_kind", "container").agg(F.sum("size").alias("used"), F.first("least").alias("l"), F.first("capacity").alias("capacity"))
    total = total.groupBy("container_kind", "capacity").agg(
        F.count("*").alias("containers"), F.max("l").alias("least_containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest")
    )
    gap = F.col("containers") / F.col("least_containers") - 1
    unused = 1 - F.col("tokens") / (F.col("containers") * F.col("capacity"))
    return total.select("container_kind", "capacity", "containers", "least_containers", F.round(gap, 6).alias("gap"), "tokens", "fullest", F.round(unused, 6).alias("unused_share"))
