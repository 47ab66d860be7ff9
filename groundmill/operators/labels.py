"""Label masks from vectors: burning polygons and lines into cells, tiles with and without labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.operators.focal import dilate
from groundmill.operators.spatial import box_ring, candidate_pairs, edges


def _sides(ring: Column) -> Column:
    """A ring's sides as struct<x0,y0,x1,y1>, from the lower end to the upper; a ring that is one point is one side."""
    flat = lambda a, b: F.struct(*((p[k].cast("double") + 0.0).alias(n) for p, k, n in ((a, "x", "x0"), (a, "y", "y0"), (b, "x", "x1"), (b, "y", "y1"))))
    up = F.transform(edges(ring), lambda e: F.when(e["a"]["y"] <= e["b"]["y"], flat(e["a"], e["b"])).otherwise(flat(e["b"], e["a"])))
    return F.when(F.size(up) > 0, up).otherwise(F.transform(F.slice(ring, 1, 1), lambda p: flat(p, p)))


#: Sides that only run along a cell's border, or pass it by rounding, touch nothing inside it.
HAIR = 1e-9


def rasterize(polys: DataFrame, id: str, ring: str = "ring", all_touched: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, keep.., y, x)``: unit cells whose inside a ring touches, or whose centre lies inside it; rings are in cell units.

    Each side is cut at the rows it runs through and leaves in each the columns it touches and where it crosses the
    row's middle. The crossings of a row, in order, bound what lies inside. So the work grows with the length of the
    sides and with the cells found, not with the bounding box, and the rows of a large ring are rows of many tasks.
    Several rings of one ``id`` are united; null rings and rings without corners have no cells.
    """
    s, row = F.col("_s"), F.col("y")
    rows = F.sequence(F.floor(s["y0"] + HAIR), F.ceil(s["y1"] - HAIR) - 1)
    sides = polys.select(id, *keep, F.xxhash64(ring).alias("_ring"), F.posexplode(_sides(F.col(ring))).alias("_i", "_s"))
    cut = sides.withColumn("y", F.explode(F.when(F.floor(s["y0"] + HAIR) < F.ceil(s["y1"] - HAIR), rows)))
    at = lambda y: s["x0"] + F.try_divide((s["x1"] - s["x0"]) * (y - s["y0"]), s["y1"] - s["y0"])
    enter = F.when(s["y0"] >= row, s["x0"]).otherwise(at(row))
    leave = F.when(s["y1"] <= row + 1, s["x1"]).otherwise(at(row + 1))
    middle = row + 0.5
    cut = cut.select(
        id, *keep, "_ring", "y", F.when((s["y0"] > middle) != (s["y1"] > middle), F.struct(at(middle).alias("at"), "_i")).alias("_cross"),
        F.struct(F.floor(F.least(enter, leave) + HAIR).alias("a"), (F.ceil(F.greatest(enter, leave) - HAIR) - 1).alias("b")).alias("_touch"),
    )
    # Equal rings of one id cross at the same places with the same sides, and count once.
    met = cut.groupBy(id, *keep, "_ring", "y").agg(F.sort_array(F.collect_set("_cross")).alias("_c"), F.collect_set("_touch").alias("_t"))
    place = lambda k: F.ceil(F.get("_c", k)["at"] - 0.5)
    spans = F.when(F.size("_c") > 1, F.transform(F.sequence(F.lit(0), F.size("_c") - 2, F.lit(2)), lambda k: F.struct(place(k).alias("a"), (place(k + 1) - 1).alias("b"))))
    spans = F.coalesce(spans, F.slice("_t", 1, 0))
    spans = F.filter(F.concat(spans, "_t") if all_touched else spans, lambda r: r["a"] <= r["b"])
    return met.select(id, *keep, "y", F.explode(spans).alias("_r")).select(id, *keep, "y", F.explode(F.sequence("_r.a", "_r.b")).alias("x")).distinct()


def segment_distance(x: Column, y: Column, s: Column) -> Column:
    """Distance from a point to a segment struct<x0,y0,x1,y1>."""
    dx, dy = s["x1"] - s["x0"], s["y1"] - s["y0"]
    t = F.coalesce(F.try_divide((x - s["x0"]) * dx + (y - s["y0"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return F.hypot(x - (s["x0"] + t * dx), y - (s["y0"] + t * dy))


def burn_lines(segments: DataFrame, width: float, touch: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(keep.., y, x)``: cells whose centre is within half the width of a segment, plus half a cell's diagonal if ``touch``.

    Of each row only the columns beside the part of the segment that comes within reach of the row's middle are tested.
    """
    reach = width / 2 + (0.5**0.5 if touch else 0)
    span = lambda a, b: F.sequence(F.floor(F.least(a, b) - reach).cast("long"), F.floor(F.greatest(a, b) + reach).cast("long"))
    rows = segments.withColumn("y", F.explode(span(F.col("y0"), F.col("y1"))))
    x0, x1, y0, y1 = (F.col(c).cast("double") for c in ("x0", "x1", "y0", "y1"))
    # Shares of the segment's length at which it comes within reach of the row and leaves it.
    share = lambda y: F.least(F.greatest(F.coalesce(F.try_divide(y - y0, y1 - y0), F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    low, high = share(F.col("y") + 0.5 - reach), share(F.col("y") + 0.5 + reach)
    level = y0 == y1
    near = span(F.when(level, x0).otherwise(x0 + (x1 - x0) * low), F.when(level, x1).otherwise(x0 + (x1 - x0) * high))
    cells = rows.withColumn("x", F.explode(near))
    s = F.struct("x0", "y0", "x1", "y1")
    return cells.where(segment_distance(F.col("x") + 0.5, F.col("y") + 0.5, s) <= reach).select(*keep, "y", "x").distinct()


def burn_lines_px(segments: DataFrame, px: DataFrame, width: int) -> DataFrame:
    """``px`` with ``mask``: cells the segments touch, grown by width // 2 cells in all eight directions."""
    thin = burn_lines(segments, 0.0, True, ("scene_id",)).withColumn("mask", F.lit(1))
    marked = px.drop("mask").join(thin, ["scene_id", "y", "x"], "left").fillna(0, ["mask"])
    return dilate(marked, "mask", "square", 3, width // 2) if width >= 2 else marked


def tile_polygon_join(tiles: DataFrame, polys: DataFrame, poly_id: str, cell: float) -> DataFrame:
    """``(tile_id, poly_id)`` of tiles (with ``tile_id`` and ``bbox``) and polygons whose boxes meet."""
    return candidate_pairs(tiles, polys, "tile_id", poly_id, cell)


TILE = ["scene_id", "grid_i", "grid_j"]


def _labelled(cells: DataFrame, mask: str) -> DataFrame:
    """The tiles with a label cell, a row each: few beside the cells, so tasks hash them and need not sort the cells."""
    return cells.where(F.col(mask) > 0).select(*TILE).distinct().hint("shuffle_hash")


def positive_tiles(cells: DataFrame, mask: str = "mask") -> DataFrame:
    """Cells of tiles with at least one label cell."""
    return cells.join(_labelled(cells, mask), TILE, "left_semi")


def negative_tiles(cells: DataFrame, mask: str = "mask") -> DataFrame:
    """Cells of tiles without a label cell, their mask 0."""
    return cells.join(_labelled(cells, mask), TILE, "left_anti").withColumn(mask, F.lit(0))


def clip_ring(ring: Column, b: Column) -> Column:
    """A ring within a box: four half-plane passes over its sides; a ring that lies beyond one of the box's sides is empty."""
    ends = lambda k: F.transform(ring, lambda p: p[k])
    beyond = (F.array_max(ends("x")) < b["x0"]) | (F.array_min(ends("x")) > b["x1"]) | (F.array_max(ends("y")) < b["y0"]) | (F.array_min(ends("y")) > b["y1"])
    ring = F.when(beyond, F.slice(ring, 1, 0)).otherwise(ring)
    for axis, at, sign in (("x", b["x0"], 1), ("x", b["x1"], -1), ("y", b["y0"], 1), ("y", b["y1"], -1)):
        ring = _cut_half(ring, axis, at, sign)
    return ring


def _cut_half(ring: Column, axis: str, at: Column, sign: int) -> Column:
    """The part of a ring with (p[axis] - at) * sign >= 0."""
    inside = lambda p: (p[axis] - at) * sign >= 0

    def point(p: Column, q: Column) -> Column:
        share = F.try_divide(at - p[axis], q[axis] - p[axis])
        return F.struct(*((at if k == axis else p[k] + (q[k] - p[k]) * share).alias(k) for k in ("x", "y")))

    def cut(e: Column) -> Column:
        cross, end = F.array(point(e["a"], e["b"])), F.array(F.struct(e["b"]["x"].alias("x"), e["b"]["y"].alias("y")))
        return F.when(inside(e["a"]) & inside(e["b"]), end).when(inside(e["a"]), cross).when(inside(e["b"]), F.concat(cross, end)).otherwise(F.slice(end, 1, 0))

    return F.flatten(F.transform(edges(ring), cut))


def clip_to_box(polys: DataFrame, b: Column, ring: str = "ring") -> DataFrame:
    """The parts of rings within a box; the cut ring is a generated row, so that no filter works it out again."""
    return polys.withColumn(ring, F.explode(F.filter(F.array(clip_ring(F.col(ring), b)), lambda r: F.size(r) >= 3)))


def boxes_as_rings(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("ring", box_ring(F.col("bbox")))
