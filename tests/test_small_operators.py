"""Operators that no query runs, on rows worked out by hand."""

from pyspark.sql import functions as F

from groundmill.functions import pixels
from groundmill.operators import metrics, regions, spatial
from groundmill.sources import layers


def test_row_ids_repeat(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "i int, s string")
    ids = [[r[0] for r in df.select(pixels.row_uuid(["i", "s"])).collect()] for _ in range(2)]
    assert ids[0] == ids[1] and len(set(ids[0])) == 3
    assert len({r[0] for r in df.select(pixels.row_uuid()).collect()}) == 3


def test_sidecars(spark):
    a = spark.createDataFrame([("p/a.tif", "a"), ("p/b.tif", "b")], "path string, stem string")
    b = spark.createDataFrame([("q/a.shp", "a")], "path string, stem string")
    assert {(r["stem"], r["sidecar"], r["missing"]) for r in layers.pair_sidecars(a, b).collect()} == {("a", "q/a.shp", False), ("b", None, True)}


def test_region_change_and_dissolve(spark):
    def cells(some):
        return spark.createDataFrame([(0, y, x, int((y, x) in some)) for y in range(4) for x in range(5)], "scene_id long, y long, x long, mask int")

    before, after = cells({(0, 0), (0, 1), (0, 2), (3, 4)}), cells({(0, 0), (0, 2), (3, 4)})
    assert [tuple(r) for r in regions.region_change(before, after).collect()] == [(0, 2, 3)]
    one, two = (c.where("mask = 1").select("scene_id", "y", "x") for c in (cells({(0, 0), (0, 1), (3, 3)}), cells({(1, 2), (0, 1)})))
    whole = spatial.dissolve(one, two)
    assert sorted(r["count"] for r in whole.groupBy("region").count().collect()) == [1, 3]


def test_top_regions_break_ties_by_name(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, 1)], "region int, cells int")
    assert [r["region"] for r in metrics.top_regions(df, 3).collect()] == [2, 3, 1]
    assert metrics.preview(df.where(F.col("cells") > 1), 2).count() == 2
