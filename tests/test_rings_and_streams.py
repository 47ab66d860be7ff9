"""Ring areas, tile layout and whole scenes from a stream."""

import numpy as np
from pyspark.sql import functions as F

from groundmill.operators import spatial
from groundmill.sources import layers
from groundmill.streaming import jobs

RING = "array<struct<x:double,y:double>>"


def test_ring_overlaps(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    cases = [
        (square, [(2.0, 2.0), (6.0, 2.0), (6.0, 6.0), (2.0, 6.0)], 4.0),
        (square, [(2.0, -2.0), (6.0, 2.0), (2.0, 6.0), (-2.0, 2.0)], 16.0),  # a diamond round it
        (square, [(2.0, 0.0), (4.0, 2.0), (2.0, 4.0), (0.0, 2.0)], 8.0),
        (square, [(1.0, 1.0), (1.0, 3.0), (3.0, 3.0), (3.0, 1.0), (1.0, 1.0)], 4.0),  # the other way round, closed
        (square, [(4.0, 0.0), (8.0, 0.0), (8.0, 4.0)], 0.0),
        (square, [(-1.0, -1.0), (5.0, 5.0), (5.0, -1.0)], 8.0),
        ([(0.0, 0.0), (6.0, 0.0), (6.0, 6.0), (4.0, 6.0), (4.0, 2.0), (2.0, 2.0), (2.0, 6.0), (0.0, 6.0)], [(-1.0, 3.0), (7.0, 3.0), (7.0, 5.0), (-1.0, 5.0)], 8.0),
    ]
    table = spark.createDataFrame([(i, a, b, c) for i, (a, b, c) in enumerate(cases)], f"i int, a {RING}, b {RING}, want double")
    for x, y in (("a", "b"), ("b", "a")):
        for r in table.select("want", spatial.ring_overlap_area(F.col(x), F.col(y)).alias("got")).collect():
            assert abs(r["got"] - r["want"]) < 1e-9


def test_ring_overlap_of_slanted_rings_equals_a_fine_grid(spark):
    rng = np.random.default_rng(8)
    rings = []
    for _ in range(6):
        angle = np.sort(rng.random(7)) * 2 * np.pi
        radius = 2 + 3 * rng.random(7)
        rings.append([(float(4 + r * np.cos(t)), float(4 + r * np.sin(t))) for t, r in zip(angle, radius, strict=True)])
    y, x = (np.mgrid[0:1000, 0:1000] + 0.5) / 100
    inside = []
    for ring in rings:
        odd = np.zeros(x.shape, bool)
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
            if ay != by:
                odd ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        inside.append(odd)
    pairs = [(i, j, rings[i], rings[j][::-1]) for i in range(6) for j in range(i)]
    table = spark.createDataFrame(pairs, f"i int, j int, a {RING}, b {RING}")
    for r in table.select("i", "j", spatial.ring_overlap_area(F.col("a"), F.col("b")).alias("got")).collect():
        assert abs(r["got"] - (inside[r["i"]] & inside[r["j"]]).sum() / 10_000) < 0.06
    polys = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], f"id int, ring {RING}").withColumn("bbox", spatial.ring_box(F.col("ring")))
    got = {(r["a"], r["b"]) for r in spatial.overlap_pairs(polys, "id", 4.0, 0.7, exact=True).collect()}
    area = [m.sum() for m in inside]
    assert got == {(j, i) for i in range(6) for j in range(i) if (inside[i] & inside[j]).sum() > 0.7 * min(area[i], area[j])}


def test_tiles_are_pruned(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 40).alias("scene_id"), (F.col("id") / 400).cast("int").alias("grid_i"), (F.col("id") / 40 % 10).cast("int").alias("grid_j"), F.array(F.rand(1)).alias("data"), F.lit("x").alias("note"))
    layers.write_tiles(rows, str(tmp_path / "tiles"), 8)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    some = layers.read_tiles(spark, str(tmp_path / "tiles"), ["data"], [3], rows=(2, 4), cols=(1, 1))
    assert {(r["scene_id"], r["grid_i"], r["grid_j"]) for r in some.collect()} == {(3, 2, 1), (3, 3, 1), (3, 4, 1)}
    plan = some._jdf.queryExecution().executedPlan().toString()
    for part in ("GreaterThanOrEqual(grid_i,2)", "LessThanOrEqual(grid_i,4)", "scene_id,3)", "grid_j,1)"):
        assert part in plan.split("PushedFilters")[1].split("\n")[0]
    assert "note" not in plan.split("ReadSchema")[1]
    spread = spark.read.parquet(str(tmp_path / "tiles")).select("scene_id", F.input_file_name().alias("f")).groupBy("f").agg(F.count_distinct("scene_id").alias("n"))
    assert spread.agg(F.max("n")).first()[0] <= 7


def test_a_scene_over_three_batches_is_one_row(spark, tmp_path):
    schema = "scene_id long, y int, x int, v int, height int, width int"
    cell = lambda s, y, x: (s, y, x, 10 * y + x, 3, 4)
    files = [[cell(1, 0, x) for x in range(4)], [cell(1, 1, x) for x in range(4)] + [cell(2, y, x) for y in range(3) for x in range(4)], [cell(1, 2, x) for x in range(4)] + [cell(1, 0, 0), cell(3, 0, 0)], [cell(1, 2, 2), cell(2, 0, 1)]]
    whole = F.count("*") >= F.max("height") * F.max("width")
    stats = lambda df: df.groupBy("scene_id").agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    args = (str(tmp_path / "in/*"), spark.createDataFrame([], schema).schema, whole, stats, str(tmp_path / "out"), str(tmp_path / "ck"), 1)
    for k, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/f{k}"))
        jobs.stream_whole_scenes(spark, *args).awaitTermination()  # each a restart
    done = sorted((r["scene_id"], r["total"], r["n"], r["batch"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    total = sum(10 * y + x for y in range(3) for x in range(4))
    assert done == [(1, total, 12, 2), (2, total, 12, 1)]
    # A batch that runs again replaces its own rows.
    import shutil

    shutil.rmtree(tmp_path / "ck/offsets/commits")
    jobs.stream_whole_scenes(spark, *args).awaitTermination()
    again = sorted((r["scene_id"], r["total"], r["n"], r["batch"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert again == done
