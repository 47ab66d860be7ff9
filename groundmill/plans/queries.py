"""The registered queries over the driver tables, each with the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.functions import pixels
from groundmill.operators import curate, focal, labels, metrics, mosaic, normalize, polygons, regions, spatial, tiling
from groundmill.plans import compliance, greencover
from groundmill.plans.fixtures import view, with_views
from groundmill.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

THRESHOLDS = {"building": 0.5, "vegetation": 0.28, "water": 0.9}
CELL = 8.0


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_views(sql)
        return f

    return keep


def _px(spark, d):
    return view(spark, d, "px")


def _boxes(spark, d, name):
    return view(spark, d, name).withColumn("bbox", spatial.box())


def _scenes(px):
    return px.groupBy("scene_id").agg((F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width"))


CLASSES = """CASE WHEN (p_building > 0.5)::INT + (p_vegetation > 0.28)::INT + (p_water > 0.9)::INT <= 1
  THEN CASE WHEN p_building > 0.5 THEN 1 WHEN p_vegetation > 0.28 THEN 2 WHEN p_water > 0.9 THEN 3 ELSE 0 END ELSE
  (SELECT CASE WHEN round(v[1].p - v[2].p, 6) > 0.1 THEN -v[1].k WHEN p_building > 0.5 THEN 1 ELSE 2 END FROM (SELECT list_reverse_sort(list_filter(
   [{'p': p_building, 'k': -1, 'a': p_building > 0.5}, {'p': p_vegetation, 'k': -2, 'a': p_vegetation > 0.28}, {'p': p_water, 'k': -3, 'a': p_water > 0.9}], lambda s: s.a)) AS v)) END"""


@query(f"WITH c AS (SELECT scene_id, {CLASSES} AS cls FROM px) SELECT scene_id, avg((cls = 0)::INT) * 100 AS pct_0, avg((cls = 1)::INT) * 100 AS pct_1, avg((cls = 2)::INT) * 100 AS pct_2, avg((cls = 3)::INT) * 100 AS pct_3 FROM c GROUP BY scene_id")
def class_percentages(spark, d):
    return mosaic.class_percentages(_px(spark, d).withColumn("cls", mosaic.resolve_classes(THRESHOLDS)), "cls", 3)


@query(f"SELECT scene_id, y, x, {CLASSES} AS cls, CASE WHEN p_water > 0.9 THEN 3 WHEN p_vegetation > 0.28 THEN 2 WHEN p_building > 0.5 THEN 1 ELSE 0 END AS last FROM px")
def resolve_classes(spark, d):
    return _px(spark, d).select("scene_id", "y", "x", mosaic.resolve_classes(THRESHOLDS).alias("cls"), mosaic.resolve_classes(THRESHOLDS, mode="last_wins").alias("last"))


COUNTS = "sum((p AND g)::INT)::BIGINT AS tp, sum((p AND NOT g)::INT)::BIGINT AS fp, sum((NOT p AND g)::INT)::BIGINT AS fn, sum((NOT p AND NOT g)::INT)::BIGINT AS tn"


@query(f"""WITH c AS (SELECT scene_id, {COUNTS}, count(*) AS total FROM (SELECT scene_id, p_building > 0.5 AS p, gt > 0 AS g FROM px) GROUP BY scene_id)
SELECT *, round(tp / (tp + fp + fn), 4) AS iou, round(2 * tp / (2 * tp + fp + fn), 4) AS dice, round(2 * tp / (2 * tp + fp + fn), 4) AS f1, round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall FROM c""")
def confusion_metrics(spark, d):
    px = _px(spark, d).withColumn("m", (F.col("p_building") > 0.5).cast("int"))
    return metrics.confusion(px, F.col("m"), F.col("gt"), ["scene_id"]).withColumns(metrics.scores())


@query(f"SELECT scene_id, {COUNTS} FROM (SELECT scene_id, p_water > 0.9 AS p, gt > 0 AS g FROM px) GROUP BY scene_id")
def running_confusion(spark, d):
    return jobs.stream_confusion(_px(spark, d).withColumn("m", (F.col("p_water") > 0.9).cast("int")), F.col("m"), F.col("gt"))


@query(f"""WITH c AS (SELECT {COUNTS} FROM (SELECT p_building > 0.5 AS p, gt > 0 AS g FROM px)) SELECT (tp + 1e-7) / (tp + fp + fn + 1e-7) AS iou, (tp + 1e-7) / (tp + fp + 1e-7) AS precision, (tp + 1e-7) / (tp + fn + 1e-7) AS recall FROM c""")
def binary_metrics(spark, d):
    return metrics.binary_metrics(_px(spark, d), F.col("p_building"), F.col("gt")).select("iou", "precision", "recall")


AREA = "((x1 - x0) * (y1 - y0))::DOUBLE"


@query(f"SELECT rs_no, sum({AREA}) / 4046.8564224 AS total, count(*) AS polygons, min({AREA}) / 4046.8564224 AS least, max({AREA}) / 4046.8564224 AS largest, avg({AREA}) / 4046.8564224 AS mean FROM parcel GROUP BY rs_no")
def area_summary(spark, d):
    parcels = _boxes(spark, d, "parcel").withColumn("area", spatial.box_area(F.col("bbox")))
    out = metrics.area_summary(parcels, "rs_no", "area")
    return out.select("rs_no", "polygons", *(pixels.to_acres(F.col(c)).alias(c) for c in ("total", "least", "largest", "mean")))


@query(f"SELECT count(DISTINCT rs_no) AS groups, count(*) AS polygons, sum({AREA}) AS total, avg({AREA}) AS mean, min({AREA}) AS least, max({AREA}) AS largest FROM parcel")
def overall_summary(spark, d):
    return metrics.overall_summary(_boxes(spark, d, "parcel").withColumn("area", spatial.box_area(F.col("bbox"))), "rs_no", "area")


@query("SELECT file_priority, count(*) AS count FROM det GROUP BY file_priority")
def count_by_source(spark, d):
    return metrics.count_by_source(view(spark, d, "det"), "file_priority")


@query(f"SELECT sum(a) AS total, avg(a) AS mean, max(a) AS largest, min(a) AS least, sum((a < 5000)::INT)::BIGINT AS small, sum((a >= 5000 AND a < 20000)::INT)::BIGINT AS medium, sum((a >= 20000)::INT)::BIGINT AS large FROM (SELECT {AREA} * 1000 AS a FROM parcel)")
def polygon_stats(spark, d):
    return metrics.polygon_stats(_boxes(spark, d, "parcel").withColumn("area", spatial.box_area(F.col("bbox")) * 1000), "area")


STRETCH = "CASE WHEN {v} = 0 THEN 1 ELSE {v} END"


def _stretch_sql(b: str) -> str:
    v = f"CASE WHEN {b}2 > {b}1 THEN floor(255 * (least(greatest({b}, {b}1), {b}2) - {b}1) / ({b}2 - {b}1))::INT ELSE 0 END"
    return f"CASE WHEN {v} = 0 THEN 1 ELSE {v} END AS {b}_s"


@query("WITH t AS (SELECT scene_id, " + ", ".join(f"round_even(quantile_cont(CASE WHEN {b} > 0 THEN {b} END, {q}), 0) AS {b}{n}" for b in "rg" for n, q in ((1, 0.025), (2, 0.99))) + f" FROM px GROUP BY scene_id) SELECT scene_id, y, x, {_stretch_sql('r')}, {_stretch_sql('g')} FROM px JOIN t USING (scene_id)")
def percentile_stretch(spark, d):
    return normalize.percentile_stretch(_px(spark, d), ["r", "g"]).select("scene_id", "y", "x", "r_s", "g_s")


@query("WITH t AS (SELECT scene_id, min(g) AS lo, max(g) AS hi FROM px GROUP BY scene_id) SELECT scene_id, y, x, round((g - lo) / (hi - lo), 6) AS v FROM px JOIN t USING (scene_id)")
def min_max(spark, d):
    return normalize.min_max(_px(spark, d), ["g"]).select("scene_id", "y", "x", F.round("g_n", 6).alias("v"))


@query("WITH t AS (SELECT scene_id, quantile_cont(b, 0.02) AS lo, quantile_cont(b, 0.98) AS hi FROM px GROUP BY scene_id) SELECT scene_id, y, x, round(least(greatest((b - lo) / (hi - lo), 0), 1), 6) AS v FROM px JOIN t USING (scene_id)")
def clip01_percentile(spark, d):
    return normalize.clip01_percentile(_px(spark, d), "b").select("scene_id", "y", "x", F.round("b_c", 6).alias("v"))


@query("""WITH v AS (SELECT *, (r + g + b) / 3.0::DOUBLE AS k FROM px), t AS (SELECT scene_id, avg(k) AS m, stddev_pop(k) AS s FROM v WHERE k <> 0 GROUP BY scene_id)
SELECT scene_id, y, x, round((least(greatest(k, m - 2 * s), m + 2 * s) - (m - 2 * s)) / (4 * s), 6) AS v FROM v JOIN t USING (scene_id)""")
def sigma_clip(spark, d):
    return normalize.sigma_clip(_px(spark, d)).select("scene_id", "y", "x", F.round("grey_k", 6).alias("v"))


@query("SELECT scene_id, y, x, (CASE WHEN 2 * g / 255.0::DOUBLE - r / 255.0::DOUBLE - b / 255.0::DOUBLE > 0.1 THEN 1 ELSE 0 END) AS veg FROM px")
def excess_green(spark, d):
    return pixels.excess_green(_px(spark, d)).select("scene_id", "y", "x", "veg")


@query("SELECT scene_id, sum((p_building > 0.5)::INT)::BIGINT AS unit, sum((r = hi)::INT)::BIGINT AS most, sum((r > 0)::INT)::BIGINT AS positive, sum(gt)::BIGINT AS plain FROM px JOIN (SELECT scene_id, max(r) AS hi FROM px GROUP BY scene_id) USING (scene_id) GROUP BY scene_id")
def binarize(spark, d):
    px = _px(spark, d)
    for band, mode, name in (("p_building", "auto", "unit"), ("r", "auto", "most"), ("r", "positive", "positive"), ("gt", "auto", "plain")):
        px = pixels.binarize(px, band, mode).withColumnRenamed("mask", name)
    return px.groupBy("scene_id").agg(*(F.sum(c).alias(c) for c in ("unit", "most", "positive", "plain")))


@query("""SELECT s.scene_id, i AS grid_i, j AS grid_j, i * 12 AS row_off, j * 12 AS col_off, least(16, 30 - i * 12) AS win_h, least(16, 50 - j * 12) AS win_w
FROM (SELECT DISTINCT scene_id FROM px) s, range(3) a(i), range(4) c(j) WHERE least(16, 30 - i * 12) >= 8 AND least(16, 50 - j * 12) >= 8""")
def tile_grid(spark, d):
    return tiling.tile_grid(_scenes(_px(spark, d)), 16, "overlap", 0.25)


TILES = "tc AS (SELECT px.*, i, j, y - i * 12 AS ty, x - j * 12 AS tx FROM px, range(2) a(i), range(4) c(j) WHERE y >= i * 12 AND y < i * 12 + 16 AND x >= j * 12 AND x < j * 12 + 16)"


def _tiles(px):
    grid = tiling.tile_grid(_scenes(px), 16, "overlap", 0.25)
    return tiling.assign_pixels_to_tiles(px, 16, 12, grid)


@query(f"WITH {TILES} SELECT scene_id, i AS grid_i, j AS grid_j, sum(p_water) / 256 AS mean, count(*) AS cells FROM tc GROUP BY 1, 2, 3 HAVING sum(p_water) / 256 >= 0.45")
def drop_empty_tiles(spark, d):
    kept = tiling.drop_empty_tiles(_tiles(_px(spark, d)), "p_water", 16, 0.45)
    return kept.groupBy("scene_id", "grid_i", "grid_j").agg((F.sum("p_water") / 256).alias("mean"), F.count("*").alias("cells"))


@query(f"WITH {TILES} SELECT scene_id, i AS grid_i, j AS grid_j, bool_and(dem IS NOT NULL) AND quantile_cont(dem, 0.02) < quantile_cont(dem, 0.98) AND quantile_cont(r, 0.02) < quantile_cont(r, 0.98) AND count(*) = 256 AS good FROM tc GROUP BY 1, 2, 3")
def tile_quality(spark, d):
    return tiling.tile_quality(_tiles(_px(spark, d)), ["dem", "r"], 16)


@query(f"""WITH {TILES}, w AS (SELECT *, least(1.0::DOUBLE, (ty + 1) / 5.0::DOUBLE) * least(1.0::DOUBLE, (16 - ty) / 5.0::DOUBLE) * least(1.0::DOUBLE, (tx + 1) / 5.0::DOUBLE) * least(1.0::DOUBLE, (16 - tx) / 5.0::DOUBLE) AS w FROM tc)
SELECT scene_id, y, x, round(sum(w * p_building * (1 + i)) / sum(w), 11) AS p FROM w GROUP BY 1, 2, 3""")
def blend_tiles(spark, d):
    preds = _tiles(_px(spark, d)).withColumn("p", F.col("p_building") * (1 + F.col("grid_i")))
    return mosaic.blend_tiles(preds, 16, 4, "p").select("scene_id", "y", "x", F.round("p", 11).alias("p"))


@query(f"WITH {TILES} SELECT scene_id, i AS grid_i, j AS grid_j, ty, tx, round(p_water, 9) AS p FROM (SELECT *, count(*) OVER (PARTITION BY scene_id, i, j) AS n FROM tc) WHERE n = 256")
def tta_merge(spark, d):
    """The four flips, on every whole tile of every scene."""
    px = _px(spark, d)
    whole = tiling.tile_grid(_scenes(px), 16, "overlap", 0.25).where("win_h = 16 AND win_w = 16")
    cells = tiling.assign_pixels_to_tiles(px, 16, 12, whole).select("scene_id", "grid_i", "grid_j", "ty", "tx", F.col("p_water").alias("p"))
    return mosaic.tta_merge(mosaic.tta_expand(cells, 16, 4), 16, "p", variants=4).withColumn("p", F.round("p", 9))


@query(f"WITH {TILES} SELECT scene_id, i AS grid_i, j AS grid_j, ty, tx, round(p_building, 9) AS p FROM (SELECT *, count(*) OVER (PARTITION BY scene_id, i, j) AS n FROM tc) WHERE n = 256")
def tta_merge_whole(spark, d):
    """Every whole tile of every scene, chosen by its window's size."""
    px = _px(spark, d)
    whole = tiling.tile_grid(_scenes(px), 16, "overlap", 0.25).where("win_h = 16 AND win_w = 16")
    cells = tiling.assign_pixels_to_tiles(px, 16, 12, whole).select("scene_id", "grid_i", "grid_j", "ty", "tx", F.col("p_building").alias("p"))
    return mosaic.tta_merge(mosaic.tta_expand(cells, 16), 16, "p").withColumn("p", F.round("p", 9))


def mirror(c: str, n: str) -> str:
    return f"CASE WHEN {c} < 0 THEN -1 - ({c}) WHEN {c} >= {n} THEN 2 * {n} - 1 - ({c}) ELSE {c} END"


def near_sql(k: int, aggs: str, value: str) -> str:
    return f"""WITH o AS (SELECT px.scene_id, px.y, px.x, dy, dx, {mirror('px.y + dy', '30')} AS ny, {mirror('px.x + dx', '50')} AS nx FROM px, range({-(k // 2)}, {k - k // 2}) a(dy), range({-(k // 2)}, {k - k // 2}) c(dx))
SELECT o.scene_id, o.y, o.x, {aggs} FROM o JOIN (SELECT scene_id, y, x, {value} AS v FROM px) n ON o.scene_id = n.scene_id AND ny = n.y AND nx = n.x GROUP BY 1, 2, 3"""


@query(near_sql(9, "round(sqrt(greatest(avg(v * v) - avg(v) * avg(v), 0)), 6) AS v", "p_building"))
def focal_std(spark, d):
    return focal.focal_std(_px(spark, d), "p_building", 9).select("scene_id", "y", "x", F.round("focal_std", 6).alias("v"))


@query(near_sql(5, "round(avg(v), 10) AS mean, max(v) - min(v) AS spread", "p_water"))
def focal_mean_range(spark, d):
    px = focal.focal_range(focal.focal_mean(_px(spark, d), "p_water", 5), "p_water", 5)
    return px.select("scene_id", "y", "x", F.round("focal_mean", 10).alias("mean"), F.col("focal_range").alias("spread"))


@query(near_sql(3, "round(sqrt((pow(sum(v * dx * (2 - abs(dy)) / 4.0), 2) + pow(sum(v * dy * (2 - abs(dx)) / 4.0), 2)) / 2), 6) AS edge", "(r + g + b) / 3.0::DOUBLE"))
def sobel(spark, d):
    return normalize.sobel(_px(spark, d)).select("scene_id", "y", "x", F.round("edge", 6).alias("edge"))


def inside_sql(k: int, agg: str, out: str) -> str:
    return f"SELECT p.scene_id, p.y, p.x, {agg}(n.gt) AS {out} FROM px p JOIN px n ON p.scene_id = n.scene_id AND abs(p.y - n.y) <= {k // 2} AND abs(p.x - n.x) <= {k // 2} GROUP BY 1, 2, 3"


@query(f"WITH e AS ({inside_sql(3, 'min', 'e')}), g AS ({inside_sql(3, 'max', 'g')}) SELECT scene_id, y, x, e AS eroded, g AS dilated, o AS opened FROM e JOIN g USING (scene_id, y, x) JOIN (SELECT p.scene_id, p.y, p.x, max(n.e) AS o FROM px p JOIN e n ON p.scene_id = n.scene_id AND abs(p.y - n.y) <= 1 AND abs(p.x - n.x) <= 1 GROUP BY 1, 2, 3) USING (scene_id, y, x)")
def morphology(spark, d):
    px = _px(spark, d).select("scene_id", "y", "x", F.col("gt").alias("eroded"), F.col("gt").alias("dilated"), F.col("gt").alias("opened"))
    return focal.open_mask(focal.dilate(focal.erode(px, "eroded"), "dilated"), "opened")


@query("""SELECT p.scene_id, p.y, p.x, min(n.gt) AS eroded FROM px p JOIN px n ON p.scene_id = n.scene_id AND abs(p.y - n.y) + abs(p.x - n.x) <= 1 GROUP BY 1, 2, 3""")
def erode_cross(spark, d):
    return focal.erode(_px(spark, d).select("scene_id", "y", "x", F.col("gt").alias("eroded")), "eroded", "cross", 3)


@query("""WITH n AS (SELECT *, lag(p_water) OVER c AS l, lead(p_water) OVER c AS r_, lag(p_water) OVER v AS u, lead(p_water) OVER v AS d FROM px WINDOW c AS (PARTITION BY scene_id, y ORDER BY x), v AS (PARTITION BY scene_id, x ORDER BY y))
SELECT scene_id, y, x, round(degrees(atan(sqrt(pow(CASE WHEN l IS NULL THEN r_ - p_water WHEN r_ IS NULL THEN p_water - l ELSE (r_ - l) / 2 END, 2) + pow(CASE WHEN u IS NULL THEN d - p_water WHEN d IS NULL THEN p_water - u ELSE (d - u) / 2 END, 2)))), 6) AS slope FROM n""")
def slope(spark, d):
    return focal.slope(_px(spark, d), "p_water").select("scene_id", "y", "x", F.round("slope", 6).alias("slope"))


@query("""SELECT p.scene_id, p.y, p.x, (2 * p.gt + coalesce(l.gt, p.gt) + coalesce(r.gt, p.gt) + coalesce(u.gt, p.gt) + coalesce(d.gt, p.gt) - p.gt >= 3)::INT AS m FROM px p
LEFT JOIN px l ON l.scene_id = p.scene_id AND l.y = p.y AND l.x = p.x - 1 LEFT JOIN px r ON r.scene_id = p.scene_id AND r.y = p.y AND r.x = p.x + 1
LEFT JOIN px u ON u.scene_id = p.scene_id AND u.y = p.y - 1 AND u.x = p.x LEFT JOIN px d ON d.scene_id = p.scene_id AND d.y = p.y + 1 AND d.x = p.x""")
def focal_median(spark, d):
    return focal.focal_median(_px(spark, d).select("scene_id", "y", "x", F.col("gt").alias("m")), "m")


REACH = """reach(scene_id, y, x, ry, rx) AS (SELECT scene_id, y, x, y, x FROM px WHERE gt = 1
  UNION SELECT p.scene_id, p.y, p.x, q.ry, q.rx FROM reach q JOIN px p ON p.scene_id = q.scene_id AND abs(p.y - q.y) + abs(p.x - q.x) = 1 AND p.gt = 1 AND (q.ry, q.rx) < (p.y, p.x)),
lab AS (SELECT scene_id, y, x, min((ry, rx)) AS root FROM reach GROUP BY 1, 2, 3)"""


def _regions(spark, d):
    return regions.label_regions(_px(spark, d), "gt", 4)


@query(f"WITH {REACH} SELECT scene_id, y, x, root[1] AS region_y, root[2] AS region_x FROM lab")
def label_regions(spark, d):
    return _regions(spark, d).select("scene_id", "y", "x", F.col("region.y").alias("region_y"), F.col("region.x").alias("region_x"))


@query(f"WITH {REACH} SELECT scene_id, sum(n)::BIGINT AS cells, count(*) AS regions FROM (SELECT scene_id, root, count(*) AS n FROM lab GROUP BY 1, 2 HAVING count(*) >= 4) GROUP BY scene_id")
def remove_small_regions(spark, d):
    kept = regions.label_regions(regions.remove_small_regions(_px(spark, d), 4, "gt"), "gt", 4)
    return kept.groupBy("scene_id").agg(F.count("*").alias("cells"), F.count_distinct("region").alias("regions"))


SIDES = """sides AS (SELECT l.scene_id, l.root, count(*) AS s FROM lab l, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) v(dy, dx) WHERE NOT EXISTS (SELECT 1 FROM lab m WHERE m.scene_id = l.scene_id AND m.root = l.root AND m.y = l.y + dy AND m.x = l.x + dx) GROUP BY 1, 2),
sizes AS (SELECT scene_id, root, count(*) AS n FROM lab GROUP BY 1, 2)"""


@query(f"WITH {REACH}, {SIDES} SELECT scene_id, root[1] AS region_y, root[2] AS region_x, n::DOUBLE AS area_m2, s::DOUBLE AS perimeter_m, round(4 * pi() * n / (s * s), 3) AS compactness FROM sides JOIN sizes USING (scene_id, root)")
def region_attributes(spark, d):
    out = polygons.region_attributes(_regions(spark, d))
    return out.select("region.scene_id", F.col("region.y").alias("region_y"), F.col("region.x").alias("region_x"), "area_m2", "perimeter_m", "compactness")


@query(f"WITH {REACH}, {SIDES} SELECT scene_id, sum(n)::DOUBLE AS area, sum(s)::DOUBLE AS around, count(*) AS outlines FROM sides JOIN sizes USING (scene_id, root) GROUP BY scene_id")
def polygonize(spark, d):
    rings = polygons.polygonize(_regions(spark, d))
    return rings.groupBy("region.scene_id").agg(F.sum(polygons.shoelace(F.col("ring"))).alias("area"), F.sum(polygons.perimeter(F.col("ring"))).alias("around"), F.count_if(~F.col("is_hole")).alias("outlines"))


PAIRS = "d.x0 <= p.x1 AND p.x0 <= d.x1 AND d.y0 <= p.y1 AND p.y0 <= d.y1"


@query(f"SELECT det_id, parcel_id, rs_no FROM det d JOIN parcel p ON {PAIRS}")
def spatial_join(spark, d):
    return spatial.spatial_join(_boxes(spark, d, "det"), _boxes(spark, d, "parcel"), "det_id", "parcel_id", CELL).select("det_id", "parcel_id", "rs_no")


@query(f"SELECT parcel_id, rs_no, category FROM parcel p WHERE EXISTS (SELECT 1 FROM det d WHERE {PAIRS})")
def spatial_semi(spark, d):
    return spatial.spatial_semi(_boxes(spark, d, "parcel"), _boxes(spark, d, "det"), "parcel_id", "det_id", CELL).select("parcel_id", "rs_no", "category")


@query(f"SELECT det_id, file_priority FROM det d WHERE NOT EXISTS (SELECT 1 FROM parcel p WHERE {PAIRS})")
def spatial_anti(spark, d):
    return spatial.spatial_anti(_boxes(spark, d, "det"), _boxes(spark, d, "parcel"), "det_id", "parcel_id", CELL).select("det_id", "file_priority")


OVERLAP = """a.det_id < b.det_id AND greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0)
  > 0.1 * least((a.x1 - a.x0) * (a.y1 - a.y0), (b.x1 - b.x0) * (b.y1 - b.y0))"""


@query(f"SELECT a.det_id AS a, b.det_id AS b FROM det a JOIN det b ON a.x0 < b.x1 AND b.x0 < a.x1 AND {OVERLAP}")
def overlap_pairs(spark, d):
    return spatial.overlap_pairs(_boxes(spark, d, "det"), "det_id", CELL)


@query()
def suppress_overlaps(spark, d):
    return spatial.suppress_overlaps(_boxes(spark, d, "det"), "det_id", [F.col("file_priority")], CELL).select("det_id", "file_priority")


@query()
def group_nearby(spark, d):
    return spatial.group_nearby(_boxes(spark, d, "parcel"), "parcel_id", 1.5, CELL).select("parcel_id", "group")


ZONES = "z AS (SELECT *, scene_id * 100 + floor(y / 10)::BIGINT * 10 + floor(x / 10)::BIGINT AS zone FROM px)"


def _zones(px):
    return px.select("scene_id", "y", "x", (F.col("scene_id") * 100 + F.floor(F.col("y") / 10) * 10 + F.floor(F.col("x") / 10)).alias("zone"))


@query(f"WITH {ZONES} SELECT zone, 100 * avg((gt > 0)::INT) AS pct FROM z GROUP BY zone HAVING 100 * avg((gt > 0)::INT) >= 30")
def zonal_fraction_filter(spark, d):
    px = _px(spark, d)
    return spatial.zonal_fraction_filter(_zones(px).select("zone").distinct(), _zones(px), px, "zone", "gt", 30)


@query(f"WITH {ZONES} SELECT zone, avg((dem < 22)::INT) AS low_share FROM z WHERE dem IS NOT NULL GROUP BY zone HAVING avg((dem < 22)::INT) < 0.5")
def zonal_height_filter(spark, d):
    px = _px(spark, d)
    return spatial.zonal_height_filter(_zones(px).select("zone").distinct(), _zones(px), px, "zone", "dem", 22, 0.5)


@query(f"""WITH ex AS (SELECT * FROM parcel WHERE parcel_id % 7 = 0),
r2 AS (SELECT det_id, (d.x1 - d.x0) * (d.y1 - d.y0) / 4046.8564224 AS acres, parcel_id, rs_no, category FROM det d LEFT JOIN parcel p ON {PAIRS}),
r3 AS (SELECT * FROM parcel p WHERE EXISTS (SELECT 1 FROM det d WHERE {PAIRS})),
r4 AS (SELECT * FROM r2 WHERE category IS DISTINCT FROM 'PROMO' AND det_id NOT IN (SELECT det_id FROM det d JOIN ex p ON {PAIRS})),
r5 AS (SELECT * FROM r3 a WHERE category IS DISTINCT FROM 'PROMO' AND NOT EXISTS (SELECT 1 FROM ex p WHERE a.x0 <= p.x1 AND p.x0 <= a.x1 AND a.y0 <= p.y1 AND p.y0 <= a.y1) AND EXISTS (SELECT 1 FROM r4 WHERE r4.rs_no IS NOT DISTINCT FROM a.rs_no))
SELECT 'r2' AS result, count(*) AS rows, round(sum(acres), 4) AS acres FROM r2 UNION ALL SELECT 'r3', count(*), NULL FROM r3 UNION ALL SELECT 'r4', count(*), round(sum(acres), 4) FROM r4 UNION ALL SELECT 'r5', count(*), NULL FROM r5""")
def parcel_compliance(spark, d):
    det, parcels = _boxes(spark, d, "det").select("det_id", "bbox"), _boxes(spark, d, "parcel").select("parcel_id", "bbox", "rs_no", "category")
    exempt = parcels.where("parcel_id % 7 = 0").select(F.col("parcel_id").alias("plot_id"), "bbox")
    done = compliance.parcel_compliance(det, parcels, exempt, "det_id", "parcel_id", "plot_id", spatial.box_area(F.col("bbox")), CELL, dropped="PROMO")
    return done["summary"].withColumn("acres", F.expr("try_cast(acres AS double)"))


@query("SELECT parcel_id, category FROM parcel WHERE category IS DISTINCT FROM (SELECT min(category) FROM parcel)")
def exclude_category(spark, d):
    parcels = view(spark, d, "parcel").select("parcel_id", "category")
    return pixels.exclude_category(parcels, "category", parcels.agg(F.min("category")).first()[0])


@query("SELECT parcel_id FROM parcel WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT category FROM parcel WHERE coalesce(category, 'Z') > 'PROMO') f WHERE f.category IS NOT DISTINCT FROM parcel.category)")
def key_semi(spark, d):
    parcels = view(spark, d, "parcel").select("parcel_id", "category")
    flagged = view(spark, d, "parcel").where("coalesce(category, 'Z') > 'PROMO'")
    return spatial.key_semi(parcels, flagged, "category").select("parcel_id")


@query("SELECT parcel_id FROM parcel WHERE EXISTS (SELECT 1 FROM (SELECT category FROM parcel GROUP BY category HAVING count(*) > (SELECT count(*) FROM parcel) / (SELECT count(DISTINCT coalesce(category, '')) FROM parcel)) f WHERE f.category IS NOT DISTINCT FROM parcel.category)")
def key_semi_whole(spark, d):
    """Parcels of the categories that more parcels have than the mean category, counted over the whole table."""
    parcels = view(spark, d, "parcel").select("parcel_id", "category")
    sizes = parcels.groupBy("category").agg(F.count("*").alias("n"))
    often = sizes.crossJoin(parcels.agg((F.count("*") / F.count_distinct(F.coalesce("category", F.lit("")))).alias("mean"))).where("n > mean")  # one row
    return spatial.key_semi(parcels, often.select("category"), "category").select("parcel_id")


@query("SELECT det_id FROM det WHERE det_id NOT IN (SELECT parcel_id FROM parcel)")
def id_anti(spark, d):
    return spatial.id_anti(view(spark, d, "det").select("det_id"), view(spark, d, "parcel").select(F.col("parcel_id").alias("det_id")), "det_id")


@query("""WITH t AS (SELECT gt AS t, CASE WHEN p_building >= greatest(p_vegetation, p_water) THEN 0 WHEN p_vegetation >= p_water THEN 1 ELSE 2 END AS p FROM px)
SELECT cls, tp, fp, fn, tp / (tp + fp + fn) AS iou FROM (SELECT c AS cls, sum((p = c AND t = c)::INT)::BIGINT AS tp, sum((p = c AND t <> c)::INT)::BIGINT AS fp, sum((p <> c AND t = c)::INT)::BIGINT AS fn FROM t, range(3) r(c) GROUP BY c)""")
def multiclass_iou(spark, d):
    return metrics.multiclass_iou(_px(spark, d), ["p_building", "p_vegetation", "p_water"], "gt").withColumn("cls", F.col("cls").cast("long"))


@query("""WITH s AS (SELECT scene_id, sum(p_building * gt) AS i, sum(p_building) AS p, sum(gt) AS g FROM px GROUP BY scene_id) SELECT round(avg((i + 1) / (p + g - i + 1)), 9) AS iou, round(avg((2 * i + 1) / (p + g + 1)), 9) AS dice FROM s""")
def per_image_scores(spark, d):
    out = metrics.per_image(_px(spark, d), F.col("p_building"), F.col("gt"))
    return out.select(F.round("iou", 9).alias("iou"), F.round("dice", 9).alias("dice"))


@query("SELECT batch, stage, round(avg(loss) OVER (PARTITION BY stage ORDER BY batch ROWS 49 PRECEDING), 10) AS rolling FROM epoch_log")
def rolling_loss(spark, d):
    return metrics.rolling_loss(view(spark, d, "epoch_log")).select("batch", "stage", F.round("rolling", 10).alias("rolling"))


EPOCHS = "e AS (SELECT stage, epoch, avg(loss) AS loss FROM epoch_log GROUP BY stage, epoch)"


@query(f"""WITH {EPOCHS}, b AS (SELECT *, min(loss) OVER (PARTITION BY stage ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM e),
g AS (SELECT *, sum((was IS NULL OR loss < was)::INT) OVER (PARTITION BY stage ORDER BY epoch) AS run FROM b),
s AS (SELECT *, row_number() OVER (PARTITION BY stage, run ORDER BY epoch) - 1 AS since FROM g)
SELECT stage, epoch, round(loss, 6) AS loss, round(min(loss) OVER w, 6) AS best, since, max((since >= 10)::INT) OVER w = 1 AS stop FROM s WINDOW w AS (PARTITION BY stage ORDER BY epoch)""")
def early_stop(spark, d):
    log = view(spark, d, "epoch_log").groupBy("stage", "epoch").agg(F.avg("loss").alias("loss"))
    return metrics.early_stop(log).withColumn("loss", F.round("loss", 6)).withColumn("best", F.round("best", 6))


@query("SELECT batch, CASE WHEN row_number() OVER (ORDER BY batch) <= ceil(round(count(*) OVER () * 0.2, 9)) THEN 'val' ELSE 'train' END AS split FROM epoch_log")
def train_val_split(spark, d):
    return curate.train_val_split(view(spark, d, "epoch_log").select("batch"), key="batch", by_hash=False)


@query("WITH q AS (SELECT scene_id, quantile_cont((r + g + b) / 3.0::DOUBLE, 0.75) AS q FROM px GROUP BY scene_id) SELECT scene_id, y, x, ((r + g + b) / 3.0::DOUBLE > q)::INT AS mask FROM px JOIN q USING (scene_id)")
def seed_mask(spark, d):
    return curate.seed_mask(_px(spark, d)).select("scene_id", "y", "x", "mask")


@query("""WITH v AS (SELECT *, (2 * g / 255.0::DOUBLE - r / 255.0::DOUBLE - b / 255.0::DOUBLE > 0.1) AS veg FROM px),
q AS (SELECT scene_id, quantile_cont(p_water, 0.33) AS a, quantile_cont(p_water, 0.66) AS c FROM v WHERE veg GROUP BY scene_id)
SELECT scene_id, y, x, CASE WHEN NOT veg THEN 0 WHEN p_water > c THEN 3 WHEN p_water > a THEN 2 ELSE 1 END AS height_class FROM v JOIN q USING (scene_id)""")
def height_class(spark, d):
    return greencover.height_class(pixels.excess_green(_px(spark, d)), "p_water").select("scene_id", "y", "x", "height_class")


@query()
def green_cover(spark, d):
    done = greencover.green_cover(_px(spark, d).withColumn("dem", F.coalesce("dem", F.lit(20.0))))
    return done.select("scene_id", "y", "x", "veg", F.round("proxy", 6).alias("proxy"), "height_class")


@query()
def clean_mask(spark, d):
    return regions.clean_mask(_px(spark, d).select("scene_id", "y", "x", F.col("gt").alias("mask")), "building").groupBy("scene_id").agg(F.sum("mask").alias("cells"))


@query("""SELECT scene_id, i AS y, j AS x, p_building AS v FROM (SELECT scene_id, p_building, y, x FROM px) p, range(15) a(i), range(25) c(j) WHERE p.y = least(floor((i + 0.5) / 0.5)::BIGINT, 29) AND p.x = least(floor((j + 0.5) / 0.5)::BIGINT, 49)""")
def resample_nearest(spark, d):
    px = _px(spark, d).withColumnRenamed("p_building", "v")
    return tiling.resample(px, _scenes(px), "v", 0.5, "nearest").select("scene_id", "y", "x", "v")


@query("""SELECT scene_id, i AS y, j AS x, round(avg(p_building), 6) AS v FROM px p, range(15) a(i), range(25) c(j) WHERE p.y IN (2 * i, 2 * i + 1) AND p.x IN (2 * j, 2 * j + 1) GROUP BY 1, 2, 3""")
def resample_bilinear(spark, d):
    px = _px(spark, d).withColumnRenamed("p_building", "v")
    return tiling.resample(px, _scenes(px), "v", 0.5).select("scene_id", "y", "x", F.round("v", 6).alias("v"))


@query("SELECT parcel_id, (x1 - x0) * (y1 - y0) AS cells FROM parcel")
def rasterize(spark, d):
    rings = labels.boxes_as_rings(_boxes(spark, d, "parcel"))
    return labels.rasterize(rings, "parcel_id", all_touched=False).groupBy("parcel_id").agg(F.count("*").alias("cells"))


@query("SELECT parcel_id, greatest(least(x1, 100) - greatest(x0, 10), 0)::DOUBLE * greatest(least(y1, 30) - greatest(y0, 5), 0) AS area FROM parcel WHERE least(x1, 100) > greatest(x0, 10) AND least(y1, 30) > greatest(y0, 5)")
def clip_to_box(spark, d):
    rings = labels.boxes_as_rings(_boxes(spark, d, "parcel"))
    window = F.struct(*(F.lit(float(v)).alias(n) for v, n in ((10, "x0"), (5, "y0"), (100, "x1"), (30, "y1"))))
    cut = labels.clip_to_box(rings, window).select("parcel_id", F.abs(polygons.shoelace(F.col("ring"))).alias("area"))
    return cut.where("area > 0")


@query("""WITH e AS (SELECT scene_id, min(g)::DOUBLE AS lo, (max(g) - min(g)) / 1024.0::DOUBLE AS step FROM px WHERE g > 0 GROUP BY scene_id),
c AS (SELECT scene_id, lo, step, least(floor((g - lo) / step), 1023) AS bin, count(*) AS n FROM px JOIN e USING (scene_id) WHERE g > 0 GROUP BY 1, 2, 3, 4),
u AS (SELECT *, sum(n) OVER (PARTITION BY scene_id ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY scene_id) AS total FROM c),
t AS (SELECT scene_id, min(CASE WHEN cum >= total * 0.025 THEN lo + bin * step END) AS t1, min(CASE WHEN cum >= total * 0.99 THEN lo + bin * step END) AS t2 FROM u GROUP BY scene_id)
SELECT scene_id, y, x, floor(255 * (least(greatest(g, t1), t2) - t1) / (t2 - t1))::INT AS g_s FROM px JOIN t USING (scene_id)""")
def histogram_stretch(spark, d):
    return normalize.histogram_stretch(_px(spark, d), "g").select("scene_id", "y", "x", "g_s")


@query("WITH t AS (SELECT scene_id, min(b) AS lo, max(b) AS hi FROM px GROUP BY scene_id) SELECT scene_id, y, x, floor((b - lo) / (hi - lo + 1e-8::DOUBLE) * 255)::INT AS b_8, floor(r * 255 / 65535.0::DOUBLE)::INT AS r_8 FROM px JOIN t USING (scene_id)")
def to_8bit(spark, d):
    return pixels.to_8bit(pixels.to_8bit(_px(spark, d), "b", False), "r", True).select("scene_id", "y", "x", "b_8", "r_8")


@query(near_sql(7, "round(greatest(avg(v * v) - avg(v) * avg(v), 0), 6) AS texture", "p_vegetation"))
def texture_variance(spark, d):
    return focal.texture_variance(_px(spark, d), "p_vegetation").select("scene_id", "y", "x", F.round("texture", 6).alias("texture"))


@query(f"WITH {TILES} SELECT scene_id, i AS grid_i, j AS grid_j, count(*) AS cells FROM tc GROUP BY 1, 2, 3 HAVING avg((gt = 0)::INT) < 0.68")
def drop_mostly_zero(spark, d):
    kept = tiling.drop_mostly_zero(_tiles(_px(spark, d)), "gt", 0.68)
    return kept.groupBy("scene_id", "grid_i", "grid_j").agg(F.count("*").alias("cells"))


@query("""WITH p AS (SELECT scene_id, y, x, floor(r / 16)::BIGINT AS a, lead(floor(r / 16)::BIGINT) OVER (PARTITION BY scene_id, y ORDER BY x) AS c FROM px)
SELECT scene_id, wy, wx, round(avg((a - c) * (a - c)), 6) AS contrast, round(avg(1 / (1.0::DOUBLE + (a - c) * (a - c))), 6) AS homogeneity
FROM p, range(2) v(wy), range(4) h(wx) WHERE c IS NOT NULL AND y // 15 = wy AND x // 15 = wx AND x + 1 < wx * 15 + 15 GROUP BY 1, 2, 3""")
def cooccurrence(spark, d):
    out = focal.cooccurrence(_px(spark, d), "r")
    return out.select("scene_id", "wy", "wx", F.round("contrast", 6).alias("contrast"), F.round("homogeneity", 6).alias("homogeneity"))


@query(f"SELECT DISTINCT ON (stage) stage, epoch, round(loss, 6) AS loss FROM (WITH {EPOCHS} SELECT * FROM e) ORDER BY stage, loss, epoch")
def best_epoch(spark, d):
    log = view(spark, d, "epoch_log").groupBy("stage", "epoch").agg(F.avg("loss").alias("loss"))
    return metrics.best_epoch(log).withColumn("loss", F.round("loss", 6))


@query("SELECT parcel_id FROM parcel WHERE (x0, y0, x1, y1) NOT IN (SELECT (x0, y0, x1, y1) FROM parcel WHERE parcel_id % 3 = 0)")
def geometry_anti(spark, d):
    shaped = view(spark, d, "parcel").select("parcel_id", F.concat_ws(" ", "x0", "y0", "x1", "y1").alias("wkt"))
    return spatial.geometry_anti(shaped, shaped.where("parcel_id % 3 = 0")).select("parcel_id")


@query(f"SELECT count(*) AS all_count, sum(a) AS all_area, sum((k = 0)::INT)::BIGINT AS present_count, sum(a) FILTER (k = 0) AS present_area, sum((k <> 0)::INT)::BIGINT AS rest_count, sum(a) FILTER (k <> 0) AS rest_area, true AS balanced FROM (SELECT {AREA} AS a, parcel_id % 3 AS k FROM parcel)")
def verify_difference(spark, d):
    boxes = _boxes(spark, d, "parcel").select("parcel_id", "bbox")
    present = boxes.where("parcel_id % 3 = 0")
    return spatial.verify_difference(boxes, present, spatial.id_anti(boxes, present, "parcel_id"), spatial.box_area(F.col("bbox")))


@query(f"""WITH m AS ({near_sql(3, "max(1 - v) - min(CASE WHEN dy = 0 AND dx = 0 THEN 1 - v END) AS gb", "gt").replace("WITH o AS", "WITH o AS")}),
n AS ({near_sql(3, "max(1 - v) - min(CASE WHEN dy = 0 AND dx = 0 THEN 1 - v END) AS pb", "(p_building > 0.5)::INT")}),
w AS (SELECT m.scene_id, m.y, m.x, m.gb, n.pb, (SELECT max(q.gb) FROM m q WHERE q.scene_id = m.scene_id AND abs(q.y - m.y) <= 2 AND abs(q.x - m.x) <= 2) AS gw, (SELECT max(q.pb) FROM n q WHERE q.scene_id = m.scene_id AND abs(q.y - m.y) <= 2 AND abs(q.x - m.x) <= 2) AS pw FROM m JOIN n USING (scene_id, y, x))
SELECT scene_id, round(sum(pb * gw) / (sum(pb) + 1e-7), 6) AS precision, round(sum(gb * pw) / (sum(gb) + 1e-7), 6) AS recall FROM w GROUP BY scene_id""")
def boundary_f1(spark, d):
    out = metrics.boundary_f1(_px(spark, d).withColumn("m", (F.col("p_building") > 0.5).cast("int")), "m", "gt")
    return out.select("scene_id", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
