import math
import random

from slideloom.operators.regions import signed_distance_of_all


def square(x0, y0, x1, y1):
    return [(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1))]


def test_every_cell_against_the_union(spark):
    """Overlapping, nested, copied and abutting shapes make one L of two boxes and a far hole; all cells have a distance."""
    boxes = [(0, 0, 400, 400), (200, 100, 800, 300), (50, 50, 120, 120), (0, 0, 400, 400), (800, 100, 1000, 300)]
    shapes = [("i", k, [square(*b)], " TUMOR" if k % 2 else "Tumor") for k, b in enumerate(boxes)]
    shapes += [("i", 9, [square(390, 0, 2000, 2000)], "Stroma"), ("j", 10, [square(0, 0, 5, 5)], "Stroma")]
    border = [(0, 0, 400, 0), (400, 0, 400, 100), (400, 100, 1000, 100), (1000, 100, 1000, 300), (1000, 300, 400, 300), (400, 300, 400, 400), (400, 400, 0, 400), (0, 400, 0, 0)]
    rnd = random.Random(5)
    cells = [("i", k, rnd.uniform(-300, 1300), rnd.uniform(-200, 600)) for k in range(150)]
    cells += [("i", 900, 300.0, 200.0), ("i", 901, 400.0, 200.0), ("i", 902, 9000.0, 200.0), ("i", 903, 800.0, 200.0), ("i", 904, float("nan"), 1.0), ("j", 1, 1.0, 1.0)]

    def want(x, y):
        d = min(math.hypot(x - min(max(x, min(a, c)), max(a, c)), y - min(max(y, min(b, e)), max(b, e))) for a, b, c, e in border)
        return d * 0.5 * (1 if any(a < x < c and b < y < e for a, b, c, e in [*boxes, (0, 100, 1000, 300)]) else -1)

    out = signed_distance_of_all(
        spark.createDataFrame(cells, "image string, cellID bigint, x_px double, y_px double"),
        spark.createDataFrame(shapes, "image string, shape_id bigint, rings array<array<struct<x:double,y:double>>>, classification string"), "Tumor", 0.5, 25.0,
    ).collect()
    expected = {k: want(x, y) for i, k, x, y in cells if i == "i" and k != 904}
    assert {r.cellID for r in out} == set(expected) and len(out) == len(expected)
    for r in out:
        assert abs(r.signed_um - expected[r.cellID]) <= 0.0501 and r.near_boundary == int(abs(expected[r.cellID]) < 25)
