"""Queries that take all rows, against brute force on small tables."""

from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry

LINES = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_returnflag string"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Lines at a few places of two images, with labels far beyond 3."""
    folder = tmp_path_factory.mktemp("small")
    lines = [(65536 * (k % 2) + k * 7 % 11, 1 + k % 3, 300 + k * 5 % 13, 1 + k * 11 % 60, 1000.0 + k, "R") for k in range(60)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{folder}/lineitem.parquet")
    points = [(k, k % 2, [-0.1 + (44 + k % 13) / 1200, -0.1 + (k % 11) / 1200, 0.0, 0.0]) for k in range(30)]
    spark.createDataFrame(points, "vec_id bigint, label int, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder), lines, points


def labelled(lines):
    out = {}
    for o, _, part, supp, _, _ in lines:
        at = o // 65536, o % 256, part % 256
        out[at] = min(supp % 64, out.get(at, 99))
    return {at: label for at, label in out.items() if label}


def run(spark, name, folder):
    return entry.queries()[name](spark, folder).collect()


def test_order_groups_of_all_lines(spark, small):
    folder, lines, _ = small
    links = defaultdict(set)
    for _, _, p, s, _, _ in lines:
        links["p", p].add(("s", s)), links["s", s].add(("p", p))
    sizes, left = [], set(links)
    while left:
        group, front = set(), {left.pop()}
        while front:
            group |= front
            front = {n for at in front for n in links[at]} - group
        left -= group
        sizes.append(len(group))
    assert sorted(r.n for r in run(spark, "order_groups", folder)) == sorted(sizes)


def test_growth_of_all_labels(spark, small):
    folder, lines, _ = small
    held = labelled(lines)
    near = [(dy, dx) for dy in range(-2, 3) for dx in range(-2, 3)]
    wide, grown = defaultdict(set), {}
    for (i, y, x), label in held.items():
        for dy, dx in near:
            at, d = (i, y + dy, x + dx), dy * dy + dx * dx
            if 0 <= at[1] < 256 and 0 <= at[2] < 256:
                if abs(dy) + abs(dx) <= 2:
                    wide[i, label].add(at)
                if d <= 4:
                    grown[at] = min(grown.get(at, (9, 0)), (d, label))
    assert {(r.img, r.label): r.n for r in run(spark, "dilated_labels", folder)} == {k: len(v) for k, v in wide.items()}
    assert {(r.img, r.y, r.x): r.label for r in run(spark, "expanded_labels", folder)} == {at: label for at, (_, label) in grown.items()}
    assert max(label for _, label in wide) > 3


def test_values_at_points_in_their_own_image(spark, small):
    folder, lines, points = small
    top = {}
    for o, _, part, _, v, _ in lines:
        at = o // 65536, o % 256, part % 256
        top[at] = max(int(v), top.get(at, 0))
    rows = run(spark, "reference_values", folder)
    got = {(r.img, r.id): r.v for r in rows}
    at = lambda v: min(max(round((v * 1000 + 1000 - 900) * 1.2), 0), 255)
    assert got == {(i, k): top.get((i, at(e[1]), at(e[0]))) for k, i, e in points}
    assert len(rows) == 30 and any(v is not None for (i, _), v in got.items() if i == 1)


def test_all_checks_keep_their_place(spark, tmp_path):
    rois = spark.range(50).selectExpr(
        "'s' as sample_id", "concat('R', lpad(id, 2, '0')) as roi_id", "timestamp'2024-01-01 00:00:00' as proposed_at", "if(id % 4 = 0, null, 500 + id * 10) as n_cells", "0.9D as occupancy"
    )
    rois.write.parquet(f"{tmp_path}/rois.parquet")
    rows = run(spark, "ordered_checks", str(tmp_path))
    assert sorted(r.position for r in rows) == list(range(1, 51))
    assert Counter(r.level for r in rows if r.position <= 13) == {"fail": 13}
