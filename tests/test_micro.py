"""Hand-worked cases."""

import pytest
from pyspark.sql import functions as F

from groundmill.functions import pixels
from groundmill.operators import curate, focal, labels, mosaic, normalize, polygons, regions, spatial, tiling


def grid(spark, h, w, cells, name="mask"):
    rows = [(0, y, x, int((y, x) in cells)) for y in range(h) for x in range(w)]
    return spark.createDataFrame(rows, f"scene_id long, y long, x long, {name} int")


def cells_of(df, name="mask"):
    return {(r["y"], r["x"]) for r in df.where(F.col(name) == 1).collect()}


def test_open_close_fill(spark):
    block = {(y, x) for y in (2, 3, 4) for x in (2, 3, 4)}
    assert cells_of(focal.open_mask(grid(spark, 7, 7, block | {(0, 6)}))) == block
    assert cells_of(focal.close_mask(grid(spark, 7, 7, {(3, 2), (3, 4)}))) == {(3, 2), (3, 3), (3, 4)}
    ring = {(y, x) for y in (1, 2, 3) for x in (1, 2, 3)} - {(2, 2)}
    assert cells_of(regions.fill_holes(grid(spark, 5, 5, ring))) == ring | {(2, 2)}


def test_regions(spark):
    diagonal = grid(spark, 3, 3, {(0, 0), (1, 1)})
    assert [regions.label_regions(diagonal, conn=c).select("region").distinct().count() for c in (4, 8)] == [2, 1]
    two = grid(spark, 4, 4, {(0, 0), (0, 1), (2, 1), (2, 2), (2, 3)})
    assert cells_of(regions.remove_small_regions(two, 3)) == {(2, 1), (2, 2), (2, 3)}
    assert regions.label_regions(grid(spark, 2, 2, set())).count() == 0


def test_polygonize(spark):
    labels_ = regions.label_regions(grid(spark, 3, 3, {(0, 0), (1, 0), (1, 1)}))
    r = polygons.polygonize(labels_).select("ring", polygons.shoelace(F.col("ring")).alias("a"), polygons.perimeter(F.col("ring")).alias("p")).collect()
    assert len(r) == 1 and (r[0]["a"], r[0]["p"], len(r[0]["ring"])) == (3.0, 8.0, 6)


def test_stretch(spark):
    px = spark.createDataFrame([(0, 0, i, v) for i, v in enumerate((0, 10, 20, 30))], "scene_id long, y long, x long, r int")
    out = normalize.percentile_stretch(px, ["r"], 0, 100).orderBy("x")
    assert [r["r_s"] for r in out.collect()] == [1, 1, 127, 255]
    kept = normalize.percentile_stretch(px, ["r"], 0, 100, keep_nodata=True).orderBy("x")
    assert [r["r_s"] for r in kept.collect()] == [0, 1, 127, 255]


def test_classes(spark):
    thr = {"building": 0.5, "vegetation": 0.28, "water": 0.9}
    px = spark.createDataFrame([(1, 0.60, 0.65, 0.1), (2, 0.60, 0.80, 0.1), (3, 0.1, 0.1, 0.95), (4, None, 0.1, 0.1)], "k int, p_building double, p_vegetation double, p_water double")
    got = lambda m: [r["c"] for r in px.withColumn("c", mosaic.resolve_classes(thr, mode=m)).orderBy("k").collect()]
    assert got("margin") == [1, 2, 3, 0] and got("first") == [1, 1, 3, 0]


def test_blend_and_tta(spark):
    scenes = spark.createDataFrame([(0, 20, 20)], "scene_id long, height long, width long")
    px = grid(spark, 20, 20, set()).withColumn("p", F.lit(0.7))
    tiles = tiling.assign_pixels_to_tiles(px, 8, 6, tiling.tile_grid(scenes, 8, "overlap", 0.25))
    assert {round(r["p"], 12) for r in mosaic.blend_tiles(tiles, 8, 2, "p").collect()} == {0.7}
    one = grid(spark, 4, 4, set()).select(F.col("scene_id"), F.lit(0).alias("grid_i"), F.lit(0).alias("grid_j"), F.col("y").alias("ty"), F.col("x").alias("tx"), (F.col("y") * 4 + F.col("x")).cast("double").alias("p"))
    for n in (10, 4):
        back = mosaic.tta_merge(mosaic.tta_expand(one, 4, n), 4, "p", variants=n).collect()
        assert all(r["p"] == r["ty"] * 4 + r["tx"] for r in back) and len(back) == 16


def test_suppression_and_categories(spark):
    boxes = spark.createDataFrame([(1, 0.0, 10.0), (2, 8.0, 18.0), (3, 16.0, 26.0)], "id long, x0 double, x1 double").withColumn("y0", F.lit(0.0)).withColumn("y1", F.lit(1.0))
    boxes = boxes.withColumn("bbox", spatial.box())
    kept = spatial.suppress_overlaps(boxes, "id", [F.col("id")], 4.0)
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]
    rows = spark.createDataFrame([(None,), ("Land Acquisition",), ("X",)], "c string")
    assert {r["c"] for r in pixels.exclude_category(rows, "c", "Land Acquisition").collect()} == {None, "X"}


def test_projection_round_trip(spark):
    row = spark.range(1).select(pixels.to_utm(F.lit(77.5), F.lit(12.9), 43).alias("u")).select("u", pixels.from_utm(F.col("u.x"), F.col("u.y"), 43).alias("g")).first()
    assert abs(row["g"]["x"] - 77.5) < 1e-7 and abs(row["g"]["y"] - 12.9) < 1e-7
    assert 700_000 < row["u"]["x"] < 800_000 and 1_400_000 < row["u"]["y"] < 1_450_000


def test_split_is_exact(spark):
    got = curate.train_val_split(spark.range(103).select(F.col("id").cast("string").alias("stem")), 0.2).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in got} == {"val": 21, "train": 82}


def test_rotated_rectangle_and_simplify(spark):
    square = [(0.0, 0.0), (4.0, 4.0), (0.0, 8.0), (-4.0, 4.0), (0.0, 4.0)]
    pts = spark.createDataFrame([(1, x, y) for x, y in square], "id int, x double, y double").select("id", F.struct("x", "y").alias("p"))
    hull = polygons.hull_of_points(pts, ["id"])
    assert round(hull.first()["hull_area"], 9) == 32.0
    rect = polygons.min_rotated_rectangle(hull, ["id"]).first()
    assert round(rect["rect_area"], 6) == 32.0
    ring = spark.createDataFrame([(1, [(0.0, 0.0), (5.0, 0.1), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)])], "id int, ring array<struct<x:double,y:double>>")
    assert len(polygons.simplify_ring(ring, "id", 0.5).first()["ring"]) == 4


def test_lines_and_touch(spark):
    seg = spark.createDataFrame([(0, 0.5, 0.5, 4.5, 0.5)], "scene_id long, x0 double, y0 double, x1 double, y1 double")
    assert {(r["y"], r["x"]) for r in labels.burn_lines(seg, 1.0, touch=False).collect()} == {(0, x) for x in range(5)}
    box = spark.createDataFrame([(1, [(0.2, 0.2), (1.8, 0.2), (1.8, 0.8), (0.2, 0.8)])], "id int, ring array<struct<x:double,y:double>>")
    assert labels.rasterize(box, "id").count() == 2 and labels.rasterize(box, "id", all_touched=False).count() == 2


def test_augment_keeps_shape_and_repeats(spark):
    px = grid(spark, 6, 6, {(1, 1), (2, 2)}).select(F.col("scene_id"), F.lit(0).alias("grid_i"), F.lit(0).alias("grid_j"), F.col("y").alias("ty"), F.col("x").alias("tx"), *(F.lit(0.5).alias(b) for b in "rgb"), "mask")
    for profile in ("standard", "strong"):
        a, b = (sorted(map(tuple, curate.augment(px, 6, 11, profile=profile).collect())) for _ in range(2))
        assert a == b and len(a) == 36


def test_distances_have_no_reach(spark):
    line = grid(spark, 1, 200, {(0, x) for x in range(1, 200)})
    got = {r["x"]: r["inside_distance"] for r in curate.inside_distance(line).collect()}
    assert len(got) == 200 and all(abs(got[x] - x / 199) < 1e-12 for x in range(200))
    block = grid(spark, 3, 200, {(y, x) for y in range(3) for x in range(3)})
    far = {(r["y"], r["x"]): r["weight"] for r in curate.boundary_weight(block).collect()}
    assert abs(far[1, 199] - 2.718281828459045**-3) < 1e-12 and far[1, 199] == min(far.values()) and far[1, 2] == 1.0
    holes = {(3, 2), (17, 11), (9, 30)}
    cells = spark.createDataFrame([(0, y, x, int((y, x) not in holes)) for y in range(20) for x in range(40) if (y * x) % 7 != 1], "scene_id long, y long, x long, mask int")
    held = [(r["y"], r["x"]) for r in cells.where("mask = 0").collect()]
    d = {(r["y"], r["x"]): min(((r["y"] - a) ** 2 + (r["x"] - b) ** 2) ** 0.5 for a, b in held) for r in cells.collect()}
    assert all(abs(r["inside_distance"] - d[r["y"], r["x"]] / max(d.values())) < 1e-12 for r in curate.inside_distance(cells).collect())


def test_streaming_once(spark, tmp_path):
    from groundmill.streaming.jobs import stream_scene_stats

    px = grid(spark, 2, 2, {(0, 0)})
    px.write.parquet(str(tmp_path / "in"))
    stats = lambda df: df.groupBy("scene_id").agg(F.sum("mask").alias("n"))
    for _ in range(2):
        stream_scene_stats(spark, str(tmp_path / "in"), px.schema, stats, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_confusion_counts_run_on(spark, tmp_path):
    from groundmill.streaming.jobs import stream_confusion

    rows = [(i % 3, i % 2, int(i % 5 == 0)) for i in range(60)]
    for k in range(4):
        spark.createDataFrame(rows[15 * k : 15 * k + 15], "scene_id long, p int, g int").coalesce(1).write.parquet(str(tmp_path / f"in/part={k}"))
    given = spark.readStream.schema("scene_id long, p int, g int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    counts = stream_confusion(given, F.col("p"), F.col("g"))
    run = counts.writeStream.format("memory").queryName("running").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination()
    assert len(run.recentProgress) >= 4
    want = {s: tuple(sum((p, g) == c for i, p, g in rows if i == s) for c in ((1, 1), (1, 0), (0, 1), (0, 0))) for s in range(3)}
    assert {r["scene_id"]: (r["tp"], r["fp"], r["fn"], r["tn"]) for r in spark.table("running").collect()} == want


def test_rectangles_and_numbers(spark):
    cells = [("block", y, x) for y in range(3) for x in range(4)] + [("bend", 0, 0), ("bend", 0, 1), ("bend", 1, 0)]
    cover = spark.createDataFrame([(0, y, x, (kind,)) for kind, y, x in cells], "scene_id long, y long, x long, region struct<k:string>")
    got = {r["region"]["k"]: r["rectangularity"] for r in polygons.region_attributes(cover, rectangle=True).collect()}
    assert got == {"block": 1.0, "bend": 0.75}
    numbered = polygons.sequential_id(spark.range(500).select((F.col("id") * 3).alias("k")), "k").collect()
    assert sorted((r["k"], r["id"]) for r in numbered) == [(3 * i, i + 1) for i in range(500)]
    assert polygons.sequential_id(spark.range(0), "id", "n").count() == 0


def test_erosion_table_and_flat_bands(spark):
    assert [focal.erosion_steps(n) for n in (0, 1, 5, 6, 7, 15, 16, 25, 30, 31, 300)] == [(3, 0), (3, 1), (3, 5), (3, 3), (3, 4), (3, 8), (5, 7), (5, 10), (5, 12), (7, 9), (7, 50)]
    flat = spark.createDataFrame([(0, y, x, 7, 7, 7, 0.0 if y else None) for y in range(3) for x in range(3)], "scene_id long, y long, x long, r int, g int, b int, nir double")
    assert {tuple(r["stack"]) for r in normalize.waterbody_stack(flat).collect()} == {(0.0,) * 5}


def test_sources(spark, tmp_path):
    from groundmill.sources import layers

    ring = spark.createDataFrame([(1, "a", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], "id int, name string, ring array<struct<x:double,y:double>>")
    layers.write_geojson(ring, str(tmp_path / "g"))
    back = layers.read_geojson(spark, str(tmp_path / "g"), "id int, name string").first()
    assert (back["id"], back["name"], len(back["ring"])) == (1, "a", 4)
    many = spark.range(0, 50, 1, 3).select(F.col("id").cast("int").alias("id"), F.lit('quo"te\n').alias("name"), F.array(*(F.struct((F.col("id") + x).cast("double").alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (1, 0), (1, 1)))).alias("ring"))
    layers.write_geojson(many, str(tmp_path / "m"))
    again = layers.read_geojson(spark, str(tmp_path / "m"), "id int, name string").collect()
    assert sorted((r["id"], r["name"], r["ring"][1]["x"]) for r in again) == [(i, 'quo"te\n', i + 1.0) for i in range(50)]
    ring.write.parquet(str(tmp_path / "f/one"))
    ring.write.parquet(str(tmp_path / "f/two"))
    rows = layers.read_polygon_folder(spark, str(tmp_path / "f")).orderBy("global_id").collect()
    assert [r["global_id"] for r in rows] == [0, 1] and [r["file_priority"] for r in rows] == [0, 1]
    layers.write_attributes_csv(ring, str(tmp_path / "c"))
    layers.write_by_scene(ring.withColumn("scene_id", F.lit(3)), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).first()["scene_id"] == 3
    assert layers.with_tags(ring, {"model": "m", "thr": F.lit(0.5)}).first()["tags"] == {"model": "m", "thr": "0.5"}
    (tmp_path / "t").mkdir()
    for n in ("a.tif", "a_prob.tif", "b.tif"):
        (tmp_path / "t" / n).write_bytes(b"xx")
    assert [r["stem"] for r in layers.scene_catalog(spark, str(tmp_path / "t")).collect()] == ["a", "b"]


def test_long_chains_and_many_corners(spark):
    """Rounds end when nothing is open, not after a count."""
    rows = [(i, 2.0 * i, 0.0, 2.0 * i + 1, 1.0) for i in range(30)]
    boxes = spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double").withColumn("bbox", spatial.box())
    got = {r["id"]: r["group"] for r in spatial.group_nearby(boxes, "id", 1.0, 4.0).collect()}
    assert got == {i: i - i % 2 for i in range(30)}


def test_means_near_nulls_and_on_short_lines(spark):
    px = spark.createDataFrame([(0, 0, x, v) for x, v in enumerate([1.0, None, 3.0, 4.0, 5.0])], "scene_id long, y long, x long, v double")
    got = [r["focal_mean"] for r in focal.focal_mean(px, "v", 3).orderBy("x").collect()]
    assert [round(v, 6) for v in got] == [1.0, 2.0, 3.5, 4.0, round(14 / 3, 6)]
    wide = [r["focal_mean"] for r in focal.focal_mean(px.where("x <> 1").withColumn("x", F.expr("CASE WHEN x = 0 THEN 0 ELSE x - 1 END")), "v", 11).orderBy("x").collect()]
    line = [1.0, 3.0, 4.0, 5.0]
    folded = lambda p: line[p % 8] if p % 8 < 4 else line[7 - p % 8]
    assert [round(v, 6) for v in wide] == [round(sum(folded(x + k) for k in range(-5, 6)) / 11, 6) for x in range(4)]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from groundmill.plans import graph

    context = SimpleNamespace(applicationId="cluster-without-folder", master="spark://host:7077", getConf=dict)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        graph.scratch_folder(SimpleNamespace(sparkContext=context))
