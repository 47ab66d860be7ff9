"""Plans and blocks that must not depend on a table being small."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from groundmill.operators import labels, polygons, regions, spatial, tiling
from groundmill.plans.graph import stored, tasks_for, whole_groups


def plan_after_run(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def pixels_of(spark, scenes, height, width):
    at = spark.range(scenes * height * width).select(F.floor(F.col("id") / (height * width)).alias("scene_id"), F.floor(F.col("id") % (height * width) / width).alias("y"), (F.col("id") % width).alias("x"))
    return at.withColumn("v", (F.col("y") * 3 + F.col("x")).cast("double"))


def test_cells_made_from_scenes_are_not_broadcast(spark):
    px = pixels_of(spark, 3, 8, 6)
    scenes = px.groupBy("scene_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))
    for method in ("bilinear", "nearest"):
        assert "Broadcast" not in plan_after_run(tiling.resample(px, scenes, "v", 0.5, method))
    got = {(r["y"], r["x"]): r["v"] for r in tiling.resample(px, scenes, "v", 0.5).where("scene_id = 1").collect()}
    assert got == {(y, x): 3 * (2 * y + 0.5) + 2 * x + 0.5 for y in range(4) for x in range(3)}
    assert "SortMergeJoin" in plan_after_run(tiling.reflect_tiles(px, scenes, 4, 1))  # the grid itself may be sent


def walked(cells, conn):
    """The first cell of each cell's region."""
    near = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if (dy or dx) and (conn == 8 or not (dy and dx))]
    root = {}
    for c in sorted(cells):
        todo = [] if c in root else [c]
        while todo:
            s, y, x = todo.pop()
            if (s, y, x) in cells and (s, y, x) not in root:
                root[s, y, x] = c
                todo += [(s, y + dy, x + dx) for dy, dx in near]
    return root


def test_regions_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(regions, "BLOCK", 4)
    random.seed(5)
    cells = {(s, y, x) for s in ("a", "b") for y in range(-9, 12) for x in range(-7, 14) if random.random() < 0.55}
    px = spark.createDataFrame([(s, y, x, 1) for s, y, x in cells], "scene_id string, y int, x long, mask int")
    for conn in (4, 8):
        done = regions.label_regions(px, conn=conn)
        assert dict(done.dtypes)["region"] == "struct<scene_id:string,y:int,x:bigint>"
        assert {(r["scene_id"], r["y"], r["x"]): tuple(r["region"]) for r in done.collect()} == walked(cells, conn)


def test_regions_inside_a_block_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(regions, "connected_components", None)
    px = pixels_of(spark, 3, 8, 6).withColumn("mask", F.lit(1))
    assert regions.label_regions(px).select("region").distinct().count() == 3


def rings_walked(cells):
    """The rings round the cells of one region, from the end of each ring's smallest side on."""
    sides = {}
    for y, x in cells:
        for dy, dx, a, b in ((-1, 0, (x, y), (x + 1, y)), (0, 1, (x + 1, y), (x + 1, y + 1)), (1, 0, (x + 1, y + 1), (x, y + 1)), (0, -1, (x, y + 1), (x, y))):
            if (y + dy, x + dx) not in cells:
                sides.setdefault(a, []).append(b)
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])
    todo, rings = {(a, b) for a, ends in sides.items() for b in ends}, []
    while todo:
        a, b = head = min(todo)
        ring = []
        while (a, b) in todo:
            todo.remove((a, b))
            c = max(sides[b], key=lambda c: turn(a, b, c))
            if turn(a, b, c):
                ring.append(b)
            a, b = b, c
        assert (a, b) == head
        rings.append(ring)
    return rings


def rings_of(done):
    return sorted((r["region"], [(p["x"], p["y"]) for p in r["ring"]], r["is_hole"]) for r in done.collect())


def test_rings_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(polygons, "BLOCK", 4)
    random.seed(6)
    cells = {k: {(y, x) for y in range(-9, 12) for x in range(-7, 14) if random.random() < p} for k, p in (("a", 0.55), ("b", 0.8))}
    given = [(k, y, x) for k, c in cells.items() for y, x in c]
    cover = spark.createDataFrame(given + given[:20] + [(None, 0, 0), ("a", None, 0)], "region string, y int, x long")
    area = lambda r: sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:] + r[:1]))
    want = sorted((k, [(x + 0.5, y - 2.0) for x, y in r], area(r) < 0) for k, c in cells.items() for r in rings_walked(c))
    assert any(h for _, _, h in want) and rings_of(polygons.polygonize(cover, 0.5, -2)) == want


def test_rings_inside_a_block_take_no_rounds(spark, monkeypatch):
    """Each doubling of a ring's length wrote every side once more."""
    written = []
    monkeypatch.setattr(polygons, "stored", lambda df, *a: written.append(df) or stored(df, *a))
    comb = {(y, x) for y in range(0, 40, 2) for x in range(40)} | {(y, 0) for y in range(40)}
    done = polygons.polygonize(spark.createDataFrame([(7, y, x) for y, x in comb], "region long, y long, x long"))
    assert len(written) == 2
    assert rings_of(done) == [(7, rings_walked(comb)[0], False)]
    assert "Broadcast" not in plan_after_run(done)


def test_sides_are_found_without_broadcast_cells(spark, tmp_path):
    cover = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, 1, 0)], "region long, y long, x long")
    cover.write.parquet(f"{tmp_path}/cover")
    sides = polygons.boundary_sides(spark.read.parquet(f"{tmp_path}/cover"))
    assert "Broadcast" not in plan_after_run(sides)
    assert {r["region"]: r["count"] for r in sides.groupBy("region").count().collect()} == {1: 6, 2: 4}


def test_groups_start_where_they_are_told():
    t = pa.table({"n": [1, 2, 1, 1, 2, 3], "v": list(range(6))})
    for most in (1, 2, 100):
        cut = list(whole_groups((), most, "n")(t.to_batches(max_chunksize=1)))
        assert pa.concat_tables([p for p, _ in cut]).equals(t)
        assert [p["n"].to_pylist()[i] for p, g in cut for i in range(len(g)) if not i or g[i] != g[i - 1]] == [1, 1, 1]


def test_groups_stay_whole_where_tables_are_cut():
    t = pa.table({"k": [None, None, "a", "a", "a", "b", "c", "c"], "v": list(range(8))})
    for most in (1, 2, 3, 5, 100):
        cut = list(whole_groups(["k"], most)(t.to_batches(max_chunksize=1)))
        assert pa.concat_tables([p for p, _ in cut]).equals(t)
        seen = [k for p, g in cut for k in dict.fromkeys(zip(p["k"].to_pylist(), g.tolist()))]
        assert [k for k, _ in seen] == [None, "a", "b", "c"]


def test_holes_are_found_without_windows_of_a_scene(spark):
    ring = [(0, y, x, int(max(abs(y - 3), abs(x - 3)) == 2)) for y in range(7) for x in range(7)]
    done = regions.fill_holes(spark.createDataFrame(ring, "scene_id long, y long, x long, mask int"))
    assert "Window" not in plan_after_run(done)
    assert {(r["y"], r["x"]) for r in done.where("mask = 1").collect()} == {(y, x) for y in range(1, 6) for x in range(1, 6)}


def test_rings_are_named_once_a_cut(spark):
    """Each half-plane pass named its ring three times and more, so that four passes worked it out hundreds of times."""
    ring = F.col("ring")
    window = F.struct(*(F.lit(float(v)).alias(n) for v, n in ((1, "x0"), (1, "y0"), (3, "x1"), (2, "y1"))))
    given = spark.createDataFrame([(1, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]), (2, [(9.0, 9.0), (10.0, 9.0), (9.0, 10.0)]), (3, None)], "id int, ring array<struct<x: double, y: double>>")
    assert str(labels.clip_ring(ring, window)._jc.toString()).count("ring") < 12
    assert [(r["id"], round(r["a"], 9)) for r in labels.clip_to_box(given, window).select("id", F.abs(polygons.shoelace(ring)).alias("a")).collect()] == [(1, 1.5)]
    area = str(spatial.ring_overlap_area(F.col("a"), F.col("b"))._jc.toString())
    assert area.count("zip_with") == 2


def test_tiles_are_told_apart_without_sorting_cells(spark):
    cells = pixels_of(spark, 2, 8, 8).selectExpr("scene_id", "y", "x", "floor(y / 4) AS grid_i", "floor(x / 4) AS grid_j", "int(y = 0 AND x = 0 AND scene_id = 0) AS mask")
    for kind, n in ((labels.positive_tiles, 16), (labels.negative_tiles, 112)):
        done = kind(cells).groupBy("scene_id").count()
        assert "Sort" not in plan_after_run(done)
        assert sum(r["count"] for r in done.collect()) == n


def test_zones_count_whole_cells_at_once(spark, monkeypatch):
    random.seed(3)
    box = lambda most: (lambda x, y: (x, y, x + random.random() * most, y + random.random() * most))(random.uniform(-90, 90), random.uniform(-90, 90))
    boxes, zones = [(i, *box(30 if i % 9 else 120)) for i in range(150)], [(i, *box((3, 60, 500)[i % 3])) for i in range(60)]
    table = lambda rows: spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double").withColumn("bbox", spatial.box())
    want = {}
    for z, a, b, c, d in zones:
        hit = [i for i, x0, y0, x1, y1 in boxes if a <= x1 and x0 <= c and b <= y1 and y0 <= d]
        if hit:
            want[z] = (len(hit), min(hit))
    monkeypatch.setattr(spatial, "candidate_pairs", None)
    assert {r["zone"]: (r["n"], r["first"]) for r in spatial.count_in_zones(table(zones).withColumnRenamed("id", "zone"), table(boxes), "zone", "id", 4.0).collect()} == want


def test_stored_rows_set_the_number_of_tasks(spark):
    df = spark.range(40_000).repartition("id")
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k, None) for k in keys]
    out = stored(df, 1_000_000)
    assert len(out.inputFiles()) == tasks_for(spark, 1_000_000) == 10 and out.count() == 40_000
    assert [spark.conf.get(k, None) for k in keys] == before
