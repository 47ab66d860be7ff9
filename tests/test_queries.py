"""Every registered query of the raster and polygon package against its SQL, on the smallest tables."""

import pytest
from conftest import DATA, rows_of

from groundmill.operators import regions
import groundmill.plans.more_queries  # noqa: F401  registers its queries
import groundmill.plans.vector_queries  # noqa: F401  registers its queries
from groundmill.plans.fixtures import with_views
from groundmill.plans.queries import QUERIES, SQL

@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, f"{DATA}/sf0.001").toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_whole_queries_leave_no_tile_out(spark):
    tiles = QUERIES["tta_merge_whole"](spark, f"{DATA}/sf0.001").groupBy("scene_id", "grid_i", "grid_j").count().collect()
    scenes = {r["scene_id"] for r in tiles}
    assert {(r["scene_id"], r["grid_i"], r["grid_j"]) for r in tiles} == {(s, i, j) for s in scenes for i in (0, 1) for j in (0, 1, 2)} and {r["count"] for r in tiles} == {256}
    assert QUERIES["key_semi_whole"](spark, f"{DATA}/sf0.001").count() > 0


def test_suppression_equals_the_walk(spark, duck):
    boxes = duck.sql(SQL["overlap_pairs"]).fetchall()
    rank = {i: (p, i) for i, p in duck.sql("SELECT o_orderkey, o_custkey % 5 FROM orders").fetchall()}
    near = {}
    for a, b in boxes:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    kept = set()
    for i in sorted(rank, key=rank.get):
        if not near.get(i, set()) & kept:
            kept.add(i)
    got = {r[0] for r in QUERIES["suppress_overlaps"](spark, f"{DATA}/sf0.001").collect()}
    assert got == kept


def test_nearby_groups_equal_the_walk(spark, duck):
    boxes = duck.sql(with_views("SELECT parcel_id, x0, y0, x1, y1 FROM parcel ORDER BY parcel_id")).fetchall()
    group = {}
    for k, (i, x0, y0, x1, y1) in enumerate(boxes):
        if i in group:
            continue
        group[i] = i
        for j, a0, b0, a1, b1 in boxes[k + 1 :]:
            if j not in group and max(x0 - a1, a0 - x1, 0) ** 2 + max(y0 - b1, b0 - y1, 0) ** 2 <= 1.5**2:
                group[j] = i
    assert {r["parcel_id"]: r["group"] for r in QUERIES["group_nearby"](spark, f"{DATA}/sf0.001").collect()} == group


def test_green_cover_classes_follow_its_proxy(spark):
    done = QUERIES["green_cover"](spark, f"{DATA}/sf0.001").toPandas()
    proxy = QUERIES["height_proxy"](spark, f"{DATA}/sf0.001").toPandas()
    both = done.merge(proxy, on=["scene_id", "y", "x"])
    assert len(both) == 1500 and (abs(both["proxy_x"] - both["proxy_y"]) < 2e-5).all() and (both["veg_x"] == both["veg_y"]).all()
    on = both[both["veg_x"] == 1]
    assert (both[both["veg_x"] == 0]["height_class"] == 0).all() and on.groupby("height_class")["proxy_x"].min().is_monotonic_increasing


def test_clean_mask_by_hand(spark):
    rows = [(0, y, x, int(2 <= y <= 6 and 2 <= x <= 6 and (y, x) != (4, 4) or (y, x) == (0, 9))) for y in range(10) for x in range(10)]
    px = spark.createDataFrame(rows, "scene_id long, y long, x long, mask int")
    for profile in ("building", "conservative", "cultivation", "v1", "v2"):
        out = {(r["y"], r["x"]) for r in regions.clean_mask(px, profile).where("mask = 1").collect()}
        assert (0, 9) not in out and ((4, 4) in out) == (profile not in ("v1", "cultivation")) and out <= {(y, x) for y in range(1, 8) for x in range(1, 8)}


def test_cultivation_mask_by_hand(spark):
    """A block far from the border stays as it is, a lone cell goes."""
    block = {(y, x) for y in range(5, 12) for x in range(5, 12)}
    solid = spark.createDataFrame([(0, y, x, int((y, x) in block or (y, x) == (0, 16))) for y in range(17) for x in range(17)], "scene_id long, y long, x long, mask int")
    assert {(r["y"], r["x"]) for r in regions.clean_mask(solid, "cultivation").where("mask = 1").collect()} == block


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_spatial_join_has_no_cross_product(spark):
    plan = QUERIES["spatial_join"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
