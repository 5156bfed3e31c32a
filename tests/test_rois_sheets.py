import json

from pyspark.sql import functions as F

from slideloom.operators import report, rois as R, sheets as T
from slideloom.sources import sinks


def tiles(spark, counts, n_cells=100):
    rows = [("i", s, 10 * k, 7 * k + ord(s[0]), n_cells) for s, n in counts.items() for k in range(n)]
    return spark.createDataFrame(rows, "img string, stratum string, y0 int, x0 int, n_cells int")


def allocation(spark, counts, n):
    wanted = spark.createDataFrame([("i", n)], "img string, wanted bigint")
    out = R.allocated(tiles(spark, counts), ["img"], ["y0"], wanted)
    return {r.stratum: r["count"] for r in out.groupBy("stratum").count().collect()}


def test_allocation(spark):
    assert allocation(spark, {"a": 1, "b": 5, "c": 5}, 7) == {"a": 1, "b": 3, "c": 3}
    assert allocation(spark, {"a": 2, "b": 2}, 3) == {"a": 2, "b": 1}
    assert allocation(spark, {"a": 2}, 9) == {"a": 2}


def test_holdout(spark):
    for n, share, held in ((2, 0.2, 0), (3, 0.2, 1), (2, 0.25, 0), (10, 0.25, 2), (3, 0.1, 1), (3, 0.0, 0)):
        out = R.with_roles(tiles(spark, {"a": n}), ["img"], ["y0"], share)
        assert out.where("role = 'validation'").count() == held


def test_strata(spark):
    rows = [("1", "Tumor", 0.25), ("1", "Normal", 0.75), ("2", "Tumor", 0.24), ("2", "Normal", 0.76), ("3", "A", 0.5), ("3", "B", 0.5), ("4", "Tumor", 1.0)]
    out = {r.t: r.stratum for r in R.strata(spark.createDataFrame(rows, "t string, region string, share double"), ["t"], "Tumor").collect()}
    assert out == {"1": "interface", "2": "Normal", "3": "A", "4": "Tumor"}


def test_number_grid_names(spark):
    t = spark.createDataFrame([("i", 2300), ("i", 2200), ("i", 2400)], "img string, n_cells int")
    assert R.wanted_number(t, ["img"], 30_000).collect() == [("i", 14)]
    images = spark.createDataFrame([("i", 1100, 1100), ("s", 300, 300)], "img string, h int, w int")
    assert {(r.y0, r.x0) for r in R.tile_grid(images, 500, True).collect()} == {(0, 0), (0, 500), (500, 0), (500, 500)}
    five = R.tile_grid(spark.createDataFrame([("i", 5, 7)], "img string, h int, w int"), 4, False)
    assert {(r.y0, r.y1, r.x0, r.x1) for r in five.collect()} == {(0, 4, 0, 4), (0, 4, 4, 7), (4, 5, 0, 4), (4, 5, 4, 7)}
    names = {r.roi_id for r in R.named(tiles(spark, {"a": 101}), "img").collect()}
    assert "i_R01" in names and "i_R101" in names and len(names) == 101


def test_upsert_and_stale(spark):
    s = "sample_id string, roi_id string, v string"
    old = spark.createDataFrame([("P1", f"R0{k}", "old") for k in (1, 2, 3)] + [("P2", "R01", "old")], s)
    proposed = spark.createDataFrame([("P1", "R01"), ("P1", "R02")], "sample_id string, roi_id string")
    new = spark.createDataFrame([("P1", "R01", "new")], s)
    after = R.upserted(old, new, proposed)
    assert sorted(map(tuple, after.collect())) == [("P1", "R01", "new"), ("P1", "R02", "old"), ("P2", "R01", "old")]
    assert sorted(map(tuple, R.upserted(after, new, proposed).collect())) == sorted(map(tuple, after.collect()))
    assert [r.roi_id for r in R.stale(old, proposed).collect()] == ["R03"]


def test_outlines_as_geojson(spark):
    df = spark.createDataFrame([("i", "i_R01", "validation", 0, 5, 10, 15)], "img string, roi_id string, role string, y0 int, x0 int, y1 int, x1 int")
    g = json.loads(R.geojson(df, "img").collect()[0].geojson)
    ring = g["features"][0]["geometry"]["coordinates"][0]
    assert len(ring) == 5 and ring[0] == ring[-1] == [5, 0] and g["features"][0]["properties"]["name"] == "i_R01"


PANEL = "row int, marker string, aliases string, role string, segmentation string, status string, notes string"


def match(spark, panel, names):
    p = spark.createDataFrame([(k, m, a, "", "", "", "") for k, (m, a) in enumerate(panel)], PANEL)
    c = spark.createDataFrame([("i", k, n) for k, n in enumerate(names)], "img string, index int, image_name string")
    out = T.matched_channels(c, p)
    return [(r.marker, r.how) for r in out.orderBy("index").collect()], out, p


def test_channel_matching(spark):
    assert match(spark, [("A", "X"), ("X", "")], ["x"])[0] == [("A", "alias")]
    assert match(spark, [("F4/80", "F480")], ["f4-80"])[0] == [("F4/80", "exact")]
    assert match(spark, [("P", ""), ("Q", "")], ["ch00", "ch01"])[0] == [("P", "order"), ("Q", "order")]
    assert match(spark, [("P", ""), ("Q", "")], ["ch00", "ch01", "ch02"])[0] == [(None, "unmatched")] * 3
    found, out, panel = match(spark, [("P", "p1"), ("Q", "")], ["p", "P1"])
    assert T.doubly_matched(out).collect() == [("i", "P", 2)] and T.missing_markers(out, panel).collect() == [("i", "Q")]
    assert T.channel_table(out, panel).count() == 2


def test_problems_are_all_reported(spark):
    p = spark.createDataFrame([(1, "s", "CD8", "lineage", "", ""), (2, "s", "cd-8", "x", "y", "z"), (3, "s", None, None, None, None), (4, "t", "CD8", "Nuclear ", "NUCLEAR", "OK")], "id int, sheet string, marker string, role string, segmentation string, status string")
    got = {}
    for r in T.panel_problems(p, "id", "sheet").collect():
        got.setdefault(r.id, set()).add(r.problem)
    assert got == {1: {"duplicate marker"}, 2: {"duplicate marker", "unknown role", "unknown segmentation", "unknown status"}, 3: {"marker is empty", "unknown role"}}
    assert [r.sheet for r in T.panels_without_nucleus(p, "sheet").collect()] == ["s"]
    s = spark.createDataFrame([("a b", "i", "Human", "p", "0.5"), ("x", "", "rat", "", "9"), ("x", "i", "canine", "p", "wide"), ("y", "i", "mouse", "p", "")], "sample_id string, image string, species string, panel string, pixel_size_um string")
    assert T.sample_problems(s, ["sample_id"]).count() == 1 + 5 + 2
    assert T.unknown(s, spark.createDataFrame([("y",), ("q",)], "sample_id string")).collect() == [("q",)]
    assert T.selected(s, spark.createDataFrame([("y",), ("y",)], "sample_id string")).count() == 1


def test_marker_map(spark):
    m = spark.createDataFrame([("CD8", "CD8", 1), ("CD8", "cd 8", 0), ("F4/80", "F4/80", 2)], "Marker string, Marker_orig string, Lineage int")
    used = spark.createDataFrame([("cd8 ",), ("Ki67",), (None,)], "marker string")
    got = {(r.name, r.problem) for r in T.marker_map_lint(m, used).collect()}
    assert got == {("CD8", "duplicate"), ("F4/80", "bad name"), ("F4/80", "bad lineage"), ("cd 8", "unused"), ("f4/80", "unused"), ("ki67", "not in map")}
    names = spark.createDataFrame([("F4/80",), ("F480",), ("PD-L1",)], "n string")
    assert [tuple(r) for r in T.name_collisions(names, "n").collect()] == [("F480", 2)]


def test_reports(spark):
    c = spark.createDataFrame([("a", 1, "ok", ""), ("a", 2, "fail", ""), ("a", 3, "warn", ""), ("b", 1, "info", "")], "sample_id string, seq int, level string, text string")
    assert [r.seq for r in report.ordered_checks(c).where("sample_id = 'a'").orderBy("position").collect()] == [2, 3, 1]
    assert {r.sample_id: r.passed for r in report.check_summary(c).collect()} == {"a": False, "b": True}
    rows = spark.range(1000)
    few = report.hashed_sample(rows, "id", 0.1, 20)
    assert 60 < few.count() < 140 and few.exceptAll(report.hashed_sample(rows.repartition(5), "id", 0.1, 20)).count() == 0
    one = report.provenance(rows.withColumn("k", F.lit("x")), ["k"]).collect()
    assert one == report.provenance(rows.repartition(3).withColumn("k", F.lit("x")), ["k"]).collect()
    w = spark.createDataFrame([("a", 1.0, 3), ("a", 5.0, 1), ("b", 1.0, 0)], "k string, v double, w int")
    assert {r.k: r.v for r in report.weighted(w, ["k"], "v", "w").collect()} == {"a": 2.0, "b": None}
    d = spark.createDataFrame([("b", 1, 2), ("a", 3, 4)], "marker string, display_low int, display_high int")
    assert sinks.display_script(d).collect()[0].script.split("\n")[0] == 'setChannelDisplayRange("a", 3, 4)'


def test_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([("a", 1), ("b", 1)], "s string, v int"), path, ["s"])
    sinks.write_table(spark.createDataFrame([("a", 2)], "s string, v int"), path, ["s"])
    assert sorted(map(tuple, sinks.read_stage(spark, path, "00").select("s", "v").collect())) == [("a", 2), ("b", 1)]
