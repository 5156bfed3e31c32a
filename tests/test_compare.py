from slideloom.operators.compare import worst_squares


def test_worst_squares_count_cells_without_overlap(spark):
    """A square of 16 cells, most of which share nothing with their like, comes first; one of 14 cells is left out."""
    a, b = [], []

    def cell(label, square, place, moved):
        y, x = place // 4 * 4, square * 64 + place % 4 * 4
        a.append((0, label, y, x, x + 2))
        if moved is not None:
            b.append((0, label, y, x + moved, x + moved + 2))

    for k in range(16):
        cell(1 + k, 0, k, 0 if k < 6 else 2 if k < 15 else None)  # IoU 1, 0, and no cell at all
        cell(101 + k, 1, k, 1)  # IoU 1/3
    for k in range(14):
        cell(201 + k, 2, k, 2)
    names = "img int, label bigint, y bigint, x0 bigint, x1 bigint"
    rows = worst_squares(spark.createDataFrame(a, names), spark.createDataFrame(b, names), 64).orderBy("rank").collect()
    assert [(r.gy, r.gx, r.n, r.median_iou, r["rank"]) for r in rows] == [(0, 0, 16, 0.0, 1), (0, 1, 16, 0.333333, 2)]
