"""Registered queries of slanted shapes: burnt rings and lines, boxes of unlike sizes, shapes of regions, trees or crops; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundmill.functions.pixels import excess_green
from groundmill.operators import labels, regions, spatial
from groundmill.plans import greencover
from groundmill.plans.queries import CELL, _boxes, _px, near_sql, query

#: Corners of a triangle against the clock: a side of the box and an offset for each coordinate.
TRIANGLE = (("x0", 0.317, "y0", 0.138), ("x1", -0.271, "y0", 0.729), ("x0", 0.541, "y1", -0.163))

_corners = ", ".join(f"{x} + {i}::DOUBLE AS p{k}x, {y} + {j}::DOUBLE AS p{k}y" for k, (x, i, y, j) in enumerate(TRIANGLE))
_side = lambda k, x, y: f"(p{(k + 1) % 3}x - p{k}x) * ({y} - p{k}y) - (p{(k + 1) % 3}y - p{k}y) * ({x} - p{k}x)"
_meets = " AND ".join(f"greatest({', '.join(_side(k, f'(x + {i})', f'(y + {j})') for i in (0, 1) for j in (0, 1))}) > 0" for k in range(3))
_holds = " AND ".join(f"{_side(k, '(x + 0.5::DOUBLE)', '(y + 0.5::DOUBLE)')} > 0" for k in range(3))
_span = lambda c: f"{c} + 1 > least(p0{c}, p1{c}, p2{c}) AND {c} < greatest(p0{c}, p1{c}, p2{c})"


@query(f"""WITH t AS (SELECT parcel_id, x0, x1, y0, y1, {_corners} FROM parcel),
c AS (SELECT parcel_id, y, x, {_holds} AS inside, {_span('x')} AND {_span('y')} AND {_meets} AS touched FROM t, range(0, 8) a(i), range(0, 8) b(j), LATERAL (SELECT x0 + i - 1 AS x, y0 + j - 1 AS y))
SELECT parcel_id, y, x, inside FROM c WHERE touched""")
def burn_rings(spark, d):
    """Cells that slanted rings touch, and whether their centres lie inside; the SQL looks for a line that separates cell and ring."""
    ring = F.array(*(F.struct((F.col(f"bbox.{x}") + i).alias("x"), (F.col(f"bbox.{y}") + j).alias("y")) for x, i, y, j in TRIANGLE))
    rings = _boxes(spark, d, "parcel").withColumn("ring", F.when(F.col("parcel_id") % 2 == 0, ring).otherwise(F.reverse(ring)))
    inside = labels.rasterize(rings, "parcel_id", all_touched=False).withColumn("inside", F.lit(True))
    return labels.rasterize(rings, "parcel_id").join(inside, ["parcel_id", "y", "x"], "left").fillna(False, ["inside"])


_distance = """SELECT *, sqrt(pow(x + 0.5::DOUBLE - ax - k * (bx - ax), 2) + pow(y + 0.5::DOUBLE - ay - k * (by_ - ay), 2)) AS d FROM (
 SELECT *, least(greatest(((x + 0.5::DOUBLE - ax) * (bx - ax) + (y + 0.5::DOUBLE - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)), 0), 1) AS k FROM {cells})"""


@query(f"""WITH s AS (SELECT det_id, x0, y0, x0 + 0.25::DOUBLE AS ax, CASE WHEN det_id % 3 = 0 THEN y1 + 2.5::DOUBLE ELSE y0 + 0.75::DOUBLE END AS ay, x1 + 2.125::DOUBLE AS bx, y0 + 0.75::DOUBLE AS by_ FROM det),
c AS (SELECT s.*, x0 + i - 3 AS x, y0 + j - 3 AS y FROM s, range(0, 14) a(i), range(0, 12) b(j)), d AS ({_distance.format(cells='c')})
SELECT det_id, count(*) AS cells, sum(y * 1000 + x)::BIGINT AS places FROM d WHERE d <= 0.75::DOUBLE + pow(0.5::DOUBLE, 0.5) GROUP BY det_id""")
def burn_lines(spark, d):
    """Cells that a line of width 1.5 touches, for slanted and level lines: their number and the sum of their places."""
    det = _boxes(spark, d, "det")
    low, high = F.col("bbox.y0") + 0.75, F.col("bbox.y1") + 2.5
    lines = det.select("det_id", (F.col("bbox.x0") + 0.25).alias("x0"), F.when(F.col("det_id") % 3 == 0, high).otherwise(low).alias("y0"), (F.col("bbox.x1") + 2.125).alias("x1"), low.alias("y1"))
    return labels.burn_lines(lines, 1.5, True, ("det_id",)).groupBy("det_id").agg(F.count("*").alias("cells"), F.sum(F.col("y") * 1000 + F.col("x")).alias("places"))


@query(f"""WITH s AS (SELECT scene_id, 1.25::DOUBLE AS ax, scene_id % 7 + 1.5::DOUBLE AS ay, 47.5::DOUBLE AS bx, 20.25::DOUBLE + scene_id % 5 AS by_ FROM px GROUP BY scene_id),
c AS (SELECT s.*, x, y FROM s JOIN px USING (scene_id)), d AS ({_distance.format(cells='c')}), thin AS (SELECT scene_id, y, x FROM d WHERE d <= pow(0.5::DOUBLE, 0.5))
SELECT p.scene_id, p.y, p.x, max((t.y IS NOT NULL)::INT) AS mask FROM px p LEFT JOIN thin t ON p.scene_id = t.scene_id AND abs(p.y - t.y) <= 2 AND abs(p.x - t.x) <= 2 GROUP BY 1, 2, 3""")
def burn_lines_px(spark, d):
    """A line across each scene, four cells wide: touched cells, grown twice."""
    px = _px(spark, d).select("scene_id", "y", "x")
    at = lambda v: F.lit(float(v))
    lines = px.select("scene_id").distinct().select("scene_id", at(1.25).alias("x0"), (F.col("scene_id") % 7 + 1.5).alias("y0"), at(47.5).alias("x1"), (20.25 + F.col("scene_id") % 5).alias("y1"))
    return labels.burn_lines_px(lines, px, 4)


@query("""WITH z AS (SELECT parcel_id AS zone_id, x0 - s AS x0, y0 - s AS y0, x1 + s AS x1, y1 + s AS y1 FROM (SELECT *, CASE WHEN parcel_id % 97 = 0 THEN 5000 WHEN parcel_id % 17 = 0 THEN 80 ELSE 0 END AS s FROM parcel))
SELECT zone_id, count(*) AS dets, min(det_id) AS first FROM z JOIN det d ON z.x0 <= d.x1 AND d.x0 <= z.x1 AND z.y0 <= d.y1 AND d.y0 <= z.y1 GROUP BY zone_id""")
def zones_of_all_sizes(spark, d):
    """Detections in zones of which some are as small as they and some cover the plane: each counts on grids of its size and finer."""
    grow = F.when(F.col("parcel_id") % 97 == 0, 5000).when(F.col("parcel_id") % 17 == 0, 80).otherwise(0)
    box = F.struct(*((F.col(f"bbox.{c}") + (grow if c[1] == "1" else -grow)).alias(c) for c in ("x0", "y0", "x1", "y1")))
    zones = _boxes(spark, d, "parcel").select(F.col("parcel_id").alias("zone_id"), box.alias("bbox"))
    return spatial.count_in_zones(zones, _boxes(spark, d, "det").select("det_id", "bbox"), "zone_id", "det_id", CELL).withColumnRenamed("n", "dets")


def _eight(mask: str) -> str:
    """``lab8``: cells of a mask with the first cell of their region of eight neighbours."""
    return f"""m AS (SELECT scene_id, y, x FROM px WHERE {mask}),
reach8(scene_id, y, x, ry, rx) AS (SELECT scene_id, y, x, y, x FROM m
  UNION SELECT p.scene_id, p.y, p.x, q.ry, q.rx FROM reach8 q JOIN m p ON p.scene_id = q.scene_id AND greatest(abs(p.y - q.y), abs(p.x - q.x)) = 1 AND (q.ry, q.rx) < (p.y, p.x)),
lab8 AS (SELECT scene_id, y, x, min((ry, rx)) AS root FROM reach8 GROUP BY 1, 2, 3)"""


#: Regions of eight neighbours of a sparse mask, and 1 - solidity * extent of each scene's four largest: between the
#: columns' ends the hull's upper side is the highest chord over each column, its lower side the lowest one.
SHAPES = f"""{_eight('gt = 1 AND p_vegetation < 0.7')},
size8 AS (SELECT scene_id, root, count(*) AS n, (max(x) - min(x) + 1) * (max(y) - min(y) + 1) AS box FROM lab8 GROUP BY 1, 2 HAVING count(*) >= 12 QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY count(*) DESC, root) <= 4),
col8 AS (SELECT scene_id, root, x + i AS x, min(y) AS lo, max(y) + 1 AS hi FROM lab8 JOIN size8 USING (scene_id, root), range(2) a(i) GROUP BY 1, 2, 3),
side8 AS (SELECT c.scene_id, c.root, c.x, max(p.hi + (q.hi - p.hi) * coalesce((c.x - p.x) / nullif(q.x - p.x, 0)::DOUBLE, 0)) AS top, min(p.lo + (q.lo - p.lo) * coalesce((c.x - p.x) / nullif(q.x - p.x, 0)::DOUBLE, 0)) AS low
  FROM col8 c JOIN col8 p ON p.scene_id = c.scene_id AND p.root = c.root AND p.x <= c.x JOIN col8 q ON q.scene_id = c.scene_id AND q.root = c.root AND q.x >= c.x GROUP BY 1, 2, 3),
hull8 AS (SELECT scene_id, root, sum((a + b) / 2) AS hull FROM (SELECT scene_id, root, top - low AS a, lead(top - low) OVER (PARTITION BY scene_id, root ORDER BY x) AS b FROM side8) GROUP BY 1, 2),
irr AS (SELECT scene_id, y, x, 1 - n / hull * (n / box::DOUBLE) AS irregularity FROM lab8 JOIN size8 USING (scene_id, root) JOIN hull8 USING (scene_id, root))"""


def _sparse(spark, d):
    px = _px(spark, d).withColumn("mask", ((F.col("gt") == 1) & (F.col("p_vegetation") < 0.7)).cast("int"))
    return regions.with_irregularity(px, "mask", top=4, min_cells=12)


@query(f"WITH {SHAPES} SELECT scene_id, y, x, round(coalesce(irregularity, 0), 9) AS irregularity FROM px LEFT JOIN irr USING (scene_id, y, x)")
def shape_irregularity(spark, d):
    return _sparse(spark, d).select("scene_id", "y", "x", F.round("irregularity", 9).alias("irregularity"))


_near = lambda k, f: near_sql(k, f"greatest(avg(v * v) - avg(v) * avg(v), 0)::DOUBLE AS {f}", "g::DOUBLE")
_scaled = lambda c: f"coalesce(least(greatest(({c} - {c}1) / nullif({c}99 - {c}1, 0), 0), 1), 0)"


@query(f"""WITH {SHAPES}, tex AS ({_near(7, 'tex')}), var AS ({_near(15, 'var')}),
n AS (SELECT *, lag(g) OVER c AS l, lead(g) OVER c AS r_, lag(g) OVER v AS u, lead(g) OVER v AS d FROM px WINDOW c AS (PARTITION BY scene_id, y ORDER BY x), v AS (PARTITION BY scene_id, x ORDER BY y)),
s AS (SELECT scene_id, y, x, (2 * g / 255.0::DOUBLE - r / 255.0::DOUBLE - b / 255.0::DOUBLE > 0.1) AS veg, degrees(atan(sqrt(pow(CASE WHEN l IS NULL THEN r_ - g WHEN r_ IS NULL THEN g - l ELSE (r_ - l) / 2.0::DOUBLE END, 2) + pow(CASE WHEN u IS NULL THEN d - g WHEN d IS NULL THEN g - u ELSE (d - u) / 2.0::DOUBLE END, 2)))) AS sl FROM n),
f AS (SELECT s.*, tex, sqrt(var) AS sd, coalesce(irregularity, 0) AS shape FROM s JOIN tex USING (scene_id, y, x) JOIN var USING (scene_id, y, x) LEFT JOIN irr USING (scene_id, y, x)),
e AS (SELECT scene_id, {', '.join(f"quantile_cont({c}, {q / 100}) AS {c}{q}" for c in ('tex', 'sd', 'sl') for q in (1, 99))} FROM f WHERE veg GROUP BY scene_id)
SELECT scene_id, y, x, veg::INT AS veg, round(CASE WHEN veg THEN 0.30::DOUBLE * {_scaled('tex')} + 0.25::DOUBLE * shape + 0.25::DOUBLE * {_scaled('sd')} + 0.20::DOUBLE * {_scaled('sl')} ELSE 0 END, 6) AS score FROM f LEFT JOIN e USING (scene_id)""")
def tree_vs_crop(spark, d):
    """The score of trees against crops; the class is the score above 0.5."""
    done = greencover.tree_vs_crop(excess_green(_sparse(spark, d)))
    return done.select("scene_id", "y", "x", F.col("veg").cast("int").alias("veg"), F.round("tree_score", 6).alias("score"))


@query(f"WITH {_eight('gt = 1 AND p_vegetation < 0.45 OR gt = 0 AND p_water < 0.2')} SELECT scene_id, y, x, root[1] AS region_y, root[2] AS region_x FROM lab8")
def dissolve(spark, d):
    """Two covers that touch and interlock become one set of regions."""
    px = _px(spark, d)
    done = spatial.dissolve(px.where("gt = 1 AND p_vegetation < 0.45"), px.where("gt = 0 AND p_water < 0.2"))
    return done.select("scene_id", "y", "x", F.col("region.y").alias("region_y"), F.col("region.x").alias("region_x"))
