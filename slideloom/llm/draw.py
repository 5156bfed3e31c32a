"""Samples that match target category proportions.

Method: divisor-method priorities. Every record gets a random rank within its category; the
record's priority is the middle of its cells on the category's running total, over the
category's target - for records of one cell each that is (rank - 0.5) / target. Records that
fill the categories' floors come first; then the globally smallest priorities are kept until
the draw is full. A category that runs out leaves its seats to the next priorities of others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Hash ranges by which a category is cut before it is ranked.
RANGES = 1024
#: Ranges per doubling of (1 + priority) by which a draw is cut before its priorities are ordered.
STEPS = 1024


def _same(value: Column) -> Column:
    return F.lower(F.trim(value))


def candidates(rois: DataFrame) -> DataFrame:
    """(sample_id, roi_id, s, r, n_cells): the latest proposal of each ROI with its categories.

    Of equally late proposals the largest by (n_cells, stratum, role) counts; a proposal
    without a time comes before all others. ROIs whose latest proposal has no n_cells are no
    candidates; a NULL stratum or role belongs to no category.
    """
    last = rois.groupBy("sample_id", "roi_id").agg(F.max(F.struct("proposed_at", "n_cells", "stratum", "role")).alias("l"))
    return last.select(
        "sample_id", "roi_id", _same(F.col("l.stratum")).alias("s"), _same(F.col("l.role")).alias("r"), F.col("l.n_cells").cast("bigint").alias("n_cells")
    ).where("n_cells is not null")


def assessed(rois: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target with what its candidates offer: n_rois, cells and whether it is unmet.

    Candidates are summed per category before they meet the targets. A target without any
    candidate offers 0 of both; a category with a NULL stratum or role has none.
    """
    offered = candidates(rois).groupBy("sample_id", "s", "r").agg(F.count("*").alias("n_rois"), F.sum("n_cells").alias("cells"))
    joined = targets.withColumn("s", _same(F.col("stratum"))).withColumn("r", _same(F.col("role"))).join(offered, ["sample_id", "s", "r"], "left")
    joined = joined.withColumn("n_rois", F.coalesce("n_rois", F.lit(0))).withColumn("cells", F.coalesce("cells", F.lit(0)))
    few_cells = F.col("cells") < F.col("target_share") * F.col("target_cells")
    few_rois = F.col("n_rois") < F.col("min_rois")
    reason = F.concat_ws("; ", F.when(few_cells, "too few cells"), F.when(few_rois, "too few ROIs"))
    return joined.withColumn("reason", reason)


def draw(rois: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """(draw_id, sample_id, roi_id, stratum, role, n_cells, pick_order): the ROIs drawn.

    The random order is a hash of seed, draw and ROI, so a draw can be repeated. A draw is
    full when the ROIs taken hold target_cells cells: a ROI is taken if the draw's total
    comes no farther from target_cells by it; floors are taken in any case. A draw without
    candidates, or an empty table, gives no row.

    A category of very many ROIs is first cut by ranges of the hash: cells are summed per
    range, and only ranges that start below target_cells or the floor are ranked, so that a
    window never holds more than what a draw can take and one range. The priorities of a
    draw are summed per step too, before those within a step are ordered.
    """
    t = targets.withColumn("s", _same(F.col("stratum"))).withColumn("r", _same(F.col("role")))
    t = t.select("draw_id", "sample_id", "target_cells", "stratum", "role", "s", "r", "min_rois", (F.col("target_share") * F.col("target_cells")).alias("wanted"))
    pool = candidates(rois).join(t, ["sample_id", "s", "r"])
    pool = pool.withColumn("u", F.xxhash64(F.lit(seed), "draw_id", "sample_id", "roi_id"))
    pool = pool.withColumn("range", F.shiftright("u", 54).cast("int"))
    assert RANGES == 1 << 10

    group = ["draw_id", "s", "r"]
    ranges = pool.groupBy(*group, "range", "target_cells", "min_rois").agg(F.count("*").alias("m"), F.sum("n_cells").alias("c"))
    before = Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *group, "range", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"), F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m0"), "target_cells", "min_rois"
    ).where((F.col("c0") < F.col("target_cells")) | (F.col("m0") < F.col("min_rois")))
    pool = pool.join(ranges.select(*group, "range", "c0", "m0"), [*group, "range"])

    within = Window.partitionBy(*group, "range").orderBy("u", "roi_id")
    ranked = pool.withColumn("rank", F.col("m0") + F.row_number().over(within)).withColumn(
        "until", F.col("c0") + F.sum("n_cells").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )
    # A target of nothing has no priority beyond its floor.
    priority = F.when(F.col("wanted") > 0, (F.col("until") - F.col("n_cells") / 2.0) / F.col("wanted")).otherwise(F.lit(float("inf")))
    ranked = ranked.withColumn("floor", F.when(F.col("rank") <= F.col("min_rois"), 0).otherwise(1)).withColumn("priority", priority)
    ranked = ranked.withColumn("step", F.when(F.col("priority") < float("inf"), F.floor(F.log2(1 + F.greatest("priority", F.lit(0.0))) * STEPS)).otherwise(F.lit(1 << 40)))

    # Totals up to a step of the priorities first, then the order within the steps that a draw can reach.
    steps = ranked.groupBy("draw_id", "floor", "step").agg(F.count("*").alias("m"), F.sum("n_cells").alias("c"), F.max("target_cells").alias("target_cells"))
    before = Window.partitionBy("draw_id").orderBy("floor", "step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select(
        "draw_id", "floor", "step", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m1"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c1"), "target_cells"
    ).where((F.col("floor") == 0) | (F.col("c1") <= F.col("target_cells")))
    order = Window.partitionBy("draw_id", "floor", "step").orderBy("priority", "s", "r", "rank")
    taken = ranked.join(steps.drop("target_cells"), ["draw_id", "floor", "step"])
    taken = taken.withColumn("pick_order", (F.col("m1") + F.row_number().over(order)).cast("int")).withColumn(
        "total", F.col("c1") + F.sum("n_cells").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    kept = (F.col("floor") == 0) | (
        (F.col("total") - F.col("n_cells") / 2.0 <= F.col("target_cells")) & (F.col("priority") < float("inf"))
    )
    return taken.where(kept).select("draw_id", "sample_id", "roi_id", "stratum", "role", "n_cells", "pick_order")


def report(rois: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """One row per target: what was wanted, offered and drawn, and why it is not met if so."""
    drawn = draw(rois, targets, seed).groupBy("draw_id", "stratum", "role").agg(
        F.count("*").alias("drawn_rois"), F.sum("n_cells").alias("drawn_cells")
    )
    joined = assessed(rois, targets).join(drawn, ["draw_id", "stratum", "role"], "left")
    return joined.select(
        "draw_id", "sample_id", "stratum", "role", "target_share", (F.col("target_share") * F.col("target_cells")).alias("wanted_cells"), "min_rois",
        F.col("n_rois").alias("offered_rois"), F.col("cells").alias("offered_cells"),
        F.coalesce("drawn_rois", F.lit(0)).alias("drawn_rois"), F.coalesce("drawn_cells", F.lit(0)).alias("drawn_cells"),
        F.nullif("reason", F.lit("")).alias("unmet_reason"),
    )


def unmet(rois: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """(draw_id, stratum, role): the targets that the draw has not met and that no draw could meet.

    What the draw delivers meets a target at once. Of the others, those are given whose
    candidates are too few or hold too few cells: a draw may also fall short because the
    floors of its other categories have filled it.
    """
    short = (F.col("drawn_cells") < F.col("wanted_cells")) | (F.col("drawn_rois") < F.col("min_rois"))
    return report(rois, targets, seed).where(short).where("unmet_reason is not null").select("draw_id", "stratum", "role")
