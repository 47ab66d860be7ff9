"""Polygons from regions, and their attributes, simplification and repair, as column expressions over rings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundmill.operators.spatial import edges, segments_touch
from groundmill.plans.graph import free, stored, tasks_for, whole_groups


def shoelace(ring: Column) -> Column:
    """Signed area, positive against the clock in y-up axes."""
    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]) / 2


def perimeter(ring: Column) -> Column:
    return F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]))


def drop_null_or_empty_geometry(polys: DataFrame, ring: str = "ring") -> DataFrame:
    return polys.where(F.col(ring).isNotNull() & (F.size(ring) >= 3)).where(shoelace(F.col(ring)) != 0)


def boundary_sides(cover: DataFrame) -> DataFrame:
    """Directed unit sides ``(region, x0, y0, x1, y1)`` of cells without an equal neighbour there; the region lies on one hand."""
    sides = F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(s, ("dy", "dx", "ax", "ay", "bx", "by"), strict=True))) for s in ((-1, 0, 0, 0, 1, 0), (0, 1, 1, 0, 1, 1), (1, 0, 1, 1, 0, 1), (0, -1, 0, 1, 0, 0))))
    out = cover.select("region", "y", "x", F.explode(sides).alias("s"))
    other = cover.select("region", F.col("y").alias("_y"), F.col("x").alias("_x"))
    same = (out["region"] == other["region"]) & (F.col("y") + F.col("s.dy") == F.col("_y")) & (F.col("x") + F.col("s.dx") == F.col("_x"))
    edge = out.join(other.hint("merge"), same, "left_anti")
    return edge.select("region", (F.col("x") + F.col("s.ax")).alias("x0"), (F.col("y") + F.col("s.ay")).alias("y0"), (F.col("x") + F.col("s.bx")).alias("x1"), (F.col("y") + F.col("s.by")).alias("y1"))


#: The side of the blocks in which one task follows sides.
BLOCK = 256


def _in_blocks(cover: DataFrame, dx: float, dy: float) -> DataFrame:
    """``(region, ring, first, next, low, before)``: the lines that a region's sides form inside a block of BLOCK x BLOCK cells.

    A ring that stays inside its block is a row without ``first``. Another line runs from the side ``first`` up to the
    side ``next`` of another block; ``low`` is its smallest side, ``before`` the number of its corners up to that side's.
    """
    tables, edge = whole_groups((), first="_n"), BLOCK

    def follow(batches):  # carries what it needs along: executors need not have this package
        import numpy as np
        import pyarrow as pa

        # Sides 0 to 3 run with the clock (y down) round their cell; each leaves in the direction after the one it faces.
        fy, fx = np.array([0, 1, 0, -1]), np.array([1, 0, -1, 0])
        ay, ax = np.array([0, 0, 1, 1]), np.array([0, 1, 1, 0])
        wide = edge + 2  # a block and the cells around it
        ahead = fy * wide + fx
        for t, group in tables(batches):
            y, x, by, bx = (t.column(c).to_numpy() for c in ("y", "x", "_by", "_bx"))
            key = (group * wide + y - by * edge + 1) * wide + x - bx * edge + 1  # ascending, as the rows are
            cell = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])  # a cell given twice counts once
            key, y, x, group = key[cell], y[cell], x[cell], group[cell]
            own = np.flatnonzero((y // edge == by[cell]) & (x // edge == bx[cell]))

            def has(k, key=key):
                return key[np.minimum(np.searchsorted(key, k), len(key) - 1)] == k

            open_ = [own[~has(key[own] - wide * fx[d] + fy[d])] for d in range(4)]
            at, d = np.concatenate(open_), np.repeat(np.arange(4), [len(o) for o in open_])
            if not len(at):
                continue
            o = np.argsort(key[at] * 4 + d)
            at, d = at[o], d[o]
            # The next side is that of the same cell, of the cell ahead or of the one on that cell's far side, as cells are there.
            front = has(key[at] + ahead[d])
            across = front & has(key[at] + ahead[d] + ahead[d - 1])
            d2 = (d + np.where(front, np.where(across, -1, 0), 1)) % 4
            y2, x2 = (v[at] + front * f[d] + across * f[d - 1] for v, f in ((y, fy), (x, fx)))
            code, want = key[at] * 4 + d, (key[at] + front * ahead[d] + across * ahead[d - 1]) * 4 + d2
            nxt = np.minimum(np.searchsorted(code, want), len(code) - 1)
            me = np.arange(len(at))
            nxt = np.where(code[nxt] == want, nxt, me)  # a line's last side points to itself
            y0, x0, ny, nx = y[at] + ay[d], x[at] + ax[d], y2 + ay[d2], x2 + ax[d2]
            side = (x0, y0, x0 + fx[d], y0 + fy[d])
            by_size = np.lexsort(side[::-1])
            size = np.empty_like(me)
            size[by_size] = me
            # Each side learns the smallest one ahead of it, and where it comes to in as many steps as the largest ring has.
            most, reach, low, jump = np.bincount(group[at]).max(), 1, size, nxt
            while reach < most:
                low, jump, reach = np.minimum(low, low[jump]), jump[jump], reach * 2
            ring = nxt[jump] != jump
            last = ring & (low == size[nxt])  # a ring is opened before its smallest side
            jump = np.where(last, me, nxt)
            far = (jump != me).astype("int64")
            while (jump[jump] != jump).any():
                far, jump = far + far[jump], jump[jump]
            order = np.lexsort((-far, jump))
            new = np.flatnonzero(np.append(True, jump[order][1:] != jump[order][:-1]))
            bend = (d2 != d)[order]
            corners = np.append(0, np.cumsum(bend))
            start, end = order[new], jump[order[new]]
            small = by_size[low[start]]
            place = np.empty_like(me)
            place[order] = me
            cut = ring[start]

            def row(cols, mask=cut):
                return pa.StructArray.from_arrays([pa.array(c) for c in cols], ["x0", "y0", "x1", "y1"], mask=pa.array(mask))

            points = pa.StructArray.from_arrays([pa.array(nx[order][bend] + float(dx)), pa.array(ny[order][bend] + float(dy))], ["x", "y"])
            lines = pa.ListArray.from_arrays(pa.array(np.append(corners[new], corners[-1]).astype("int32")), points)
            after = (nx[end], ny[end], nx[end] + fx[d2[end]], ny[end] + fy[d2[end]])
            out = [t.column("region").combine_chunks().take(pa.array(cell[at[start]])), lines, row(v[start] for v in side), row(after), row(v[small] for v in side), pa.array(corners[place[small]] - corners[new])]
            yield from pa.table(out, names=["region", "ring", "first", "next", "low", "before"]).to_batches(max_chunksize=10_000)

    block = lambda c, i: F.floor((F.col(c) + i) / BLOCK)
    near = lambda c: F.explode(F.array_distinct(F.array(block(c, -1), block(c, 1))))  # noqa: E731  the blocks it is in or beside
    cells = stored(cover.where("region IS NOT NULL AND y IS NOT NULL AND x IS NOT NULL").select("region", F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x")))
    dealt = cells.withColumn("_by", near("y")).withColumn("_bx", near("x")).repartition(tasks_for(cells.sparkSession, cells.count()), "region", "_by", "_bx")
    numbered = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("region", "_by", "_bx").orderBy("y", "x")))
    side = "struct<x0: long, y0: long, x1: long, y1: long>"
    made = T.StructType.fromDDL(f"ring array<struct<x: double, y: double>>, first {side}, next {side}, low {side}, before long")
    return numbered.mapInArrow(follow, T.StructType([cells.schema["region"], *made.fields]))


def polygonize(cover: DataFrame, dx: float = 0.0, dy: float = 0.0, rounds: int = 40) -> DataFrame:
    """``(region, ring, is_hole)``: the rings round each region of ``cover(region, y, x)``, corners only, moved by (dx, dy).

    Sides are followed inside blocks of cells, each in one task; where two leave a corner the one that keeps the region's
    cells apart is taken. Lines that leave their block are put together by pointer doubling: each learns the smallest side
    within 2^k lines and the lines to it. A ring begins at the end of its smallest side.
    """
    lines = stored(_in_blocks(cover, dx, dy))
    rings = lines.where("first IS NULL").select("region", "ring")
    open_ = lines.where("first IS NOT NULL")
    longest = open_.groupBy("region").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if longest:
        # jump: the line 2^k ahead; low: the smallest side met from here before it, with the lines to it.
        state, reach = stored(open_.select("region", "first", F.col("next").alias("jump"), F.struct(F.col("low").alias("side"), F.lit(0).cast("long").alias("steps")).alias("low"))), 1
        for _ in range(rounds):
            if reach >= longest:
                break
            ahead = state.select(F.col("region").alias("r2"), F.col("first").alias("f2"), F.col("jump").alias("jump2"), F.col("low").alias("low2"))
            far = F.struct(F.col("low2.side").alias("side"), (F.col("low2.steps") + reach).alias("steps"))
            met = state.hint("merge").join(ahead, (F.col("region") == F.col("r2")) & (F.col("jump") == F.col("f2")))
            before, state = state, stored(met.select("region", "first", F.col("jump2").alias("jump"), F.least(F.col("low"), far).alias("low")))
            free(before)
            reach *= 2
        placed = state.select("region", "first", F.col("low.side").alias("head"), F.col("low.steps").alias("steps")).hint("merge").join(open_.select("region", "first", "ring", "before"), ["region", "first"])
        # The line that holds the smallest side comes first, from that side's corner on; the others count down to it.
        line = F.struct(F.when(F.col("steps") == 0, F.lit(-(1 << 40))).otherwise(-F.col("steps")).alias("at"), "before", "ring")
        joined = placed.groupBy("region", "head").agg(F.sort_array(F.collect_list(line)).alias("l")).select("region", F.flatten("l.ring").alias("ring"), F.col("l")[0]["before"].cast("int").alias("n"))
        turned = F.concat(F.slice("ring", F.col("n") + 1, F.size("ring")), F.slice("ring", F.lit(1), F.col("n")))
        rings = rings.unionByName(joined.select("region", turned.alias("ring")))
    return rings.withColumn("is_hole", shoelace(F.col("ring")) < 0)


def region_attributes(cover: DataFrame, cell: float = 1.0, rectangle: bool = False) -> DataFrame:
    """``(region, area_m2, area_ha, perimeter_m, compactness, elongation)`` from cells; the perimeter counts boundary sides.

    With ``rectangle`` also ``rectangularity``, the area's share of the smallest rectangle around the region.
    """
    area = cover.groupBy("region").agg(F.count("*").alias("n"))
    around = boundary_sides(cover).groupBy("region").agg(F.count("*").alias("sides"))
    a, p = F.col("n") * cell * cell, F.col("sides") * cell
    from math import pi

    found, more = area.join(around, "region"), []
    if rectangle:
        corners = F.array(*(F.struct((F.col("x") + i).cast("double").alias("x"), (F.col("y") + j).cast("double").alias("y")) for i in (0, 1) for j in (0, 1)))
        hulls = hull_of_points(cover.select("region", F.explode(corners).alias("p")), ["region"])
        found = found.join(min_rotated_rectangle(hulls, ["region"], min_area=0).select("region", "rect_area"), "region")
        more = [F.round(F.col("n") / F.col("rect_area"), 3).alias("rectangularity")]
    return found.select(
        "region", F.round(a.cast("double"), 2).alias("area_m2"), F.round(a / 10000, 4).alias("area_ha"), F.round(p.cast("double"), 2).alias("perimeter_m"),
        F.round(4 * pi * a / (p * p), 3).alias("compactness"), F.round(p / (2 * F.sqrt(pi * a)), 3).alias("elongation"), *more,
    )


def sequential_id(polys: DataFrame, order: str, name: str = "id") -> DataFrame:
    """``polys`` numbered from 1 in the order of the column ``order``, which must tell the rows apart.

    The rows are dealt into ranges and ranked inside each; only the ranges' counts, one row a partition, are summed in one task.
    """
    dealt = stored(polys.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part").count()
    before = counts.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(order)))
    return ranked.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_rank")).drop("_part", "_before", "_rank")


def ring_attributes(polys: DataFrame, ring: str = "ring") -> DataFrame:
    """``polys`` with area, perimeter, hectares and compactness; ``sequential_id`` numbers them."""
    a, p = F.abs(shoelace(F.col(ring))), perimeter(F.col(ring))
    from math import pi

    return polys.withColumn("area_m2", F.round(a, 2)).withColumn("area_ha", F.round(a / 10000, 4)).withColumn("perimeter_m", F.round(p, 2)).withColumn("compactness", F.round(F.coalesce(F.try_divide(4 * pi * a, p * p), F.lit(0.0)), 3))


def hull_of_points(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, hull, hull_area)`` of ``points(keys, p)``: the convex hull, against the clock.

    Only the lowest and highest point of each column can be corners; these few are folded once per half by the
    monotone chain, as an expression.
    """
    ends = points.groupBy(*keys, F.col("p.x").alias("x")).agg(F.min("p.y").alias("lo"), F.max("p.y").alias("hi"))
    cols = ends.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("x", "lo", "hi"))).alias("c"))

    def chain(pts: Column) -> Column:
        empty = F.expr("CAST(array() AS array<struct<x:double,y:double>>)")

        def push(acc: Column, p: Column) -> Column:
            # Corners that the new point leaves inside are dropped from the end: keep up to the last strict left turn.
            n = F.size(acc)
            good = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: (n > 0) & ((i == 0) | _left(F.get(acc, i - 1), F.get(acc, i), p)))
            last = F.array_max(good)
            return F.concat(F.when(n == 0, empty).otherwise(F.slice(acc, F.lit(1), F.coalesce(last, F.lit(0)) + 1)), F.array(p))

        return F.aggregate(pts, empty, push)

    pt = lambda c, y: F.struct(c["x"].cast("double").alias("x"), c[y].cast("double").alias("y"))
    lower = chain(F.transform("c", lambda c: pt(c, "lo")))
    upper = chain(F.reverse(F.transform("c", lambda c: pt(c, "hi"))))
    hull = F.array_distinct(F.concat(lower, upper))
    return cols.select(*keys, hull.alias("hull")).withColumn("hull_area", F.abs(shoelace(F.col("hull"))))


def _left(a: Column, b: Column, p: Column) -> Column:
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"]) > 0


def min_rotated_rectangle(hulls: DataFrame, keys: Sequence[str], hull: str = "hull", min_area: float = 10) -> DataFrame:
    """``(keys, width, height, angle, rect_area)``: the smallest rectangle along a hull side; smaller ones than ``min_area`` go."""
    from math import pi

    side = hulls.select(*keys, hull, F.explode(edges(F.col(hull))).alias("e"))
    turned = side.withColumn("angle", F.atan2(F.col("e.b.y") - F.col("e.a.y"), F.col("e.b.x") - F.col("e.a.x")))
    c, s = F.cos("angle"), F.sin("angle")
    u, v = F.transform(hull, lambda p: p["x"] * c + p["y"] * s), F.transform(hull, lambda p: p["y"] * c - p["x"] * s)
    sized = turned.withColumn("w", F.array_max(u) - F.array_min(u)).withColumn("h", F.array_max(v) - F.array_min(v)).withColumn("area", F.col("w") * F.col("h"))
    best = sized.groupBy(*keys).agg(F.min(F.struct("area", "angle", "w", "h")).alias("m"))
    return best.where(F.col("m.area") >= min_area).select(*keys, F.col("m.w").alias("width"), F.col("m.h").alias("height"), (F.col("m.angle") * 180 / pi).alias("angle"), F.col("m.area").alias("rect_area"))


def smooth_corners(ring: Column, times: int = 3) -> Column:
    """Each side's quarter points in place of its ends, ``times`` over."""
    point = lambda a, b, t: F.struct((a["x"] * (1 - t) + b["x"] * t).alias("x"), (a["y"] * (1 - t) + b["y"] * t).alias("y"))
    for _ in range(times):
        ring = F.flatten(F.transform(edges(ring), lambda e: F.array(point(e["a"], e["b"], 0.25), point(e["a"], e["b"], 0.75))))
    return ring


def simplify_ring(polys: DataFrame, id: str, tol: float, ring: str = "ring") -> DataFrame:
    """Rings without corners closer than ``tol`` to the chord of kept ones; a result of no area leaves the ring as it was.

    All spans of a round are cut at once at their farthest corner, until no corner is farther than ``tol``.
    """
    corners = stored(polys.select(id, F.posexplode(ring).alias("i", "p")))
    size = corners.groupBy(id).agg(F.count("*").alias("n"))
    far = corners.join(corners.where("i = 0").select(id, F.col("p").alias("p0")), id).groupBy(id).agg(F.max_by("i", F.hypot(F.col("p.x") - F.col("p0.x"), F.col("p.y") - F.col("p0.y"))).alias("i"))
    kept = stored(size.select(id, F.lit(0).alias("i")).unionByName(far.select(id, "i")).unionByName(size.select(id, F.col("n").cast("int").alias("i"))).distinct())
    closed = corners.unionByName(corners.where("i = 0").join(size, id).select(id, F.col("n").cast("int").alias("i"), "p"))
    while True:  # every round keeps at least one more corner, or ends
        w = Window.partitionBy(id).orderBy("i")
        flagged = closed.join(kept.withColumn("keep", F.lit(1)), [id, "i"], "left")
        span = flagged.withColumn("a", F.last(F.when(F.col("keep") == 1, F.struct("i", "p")), ignorenulls=True).over(w)).withColumn("b", F.first(F.when(F.col("keep") == 1, F.struct("i", "p")), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
        a, b, p = F.col("a.p"), F.col("b.p"), F.col("p")
        length = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
        off = F.when(length == 0, F.hypot(p["x"] - a["x"], p["y"] - a["y"])).otherwise(F.abs((b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])) / length)
        new = span.where("keep IS NULL").withColumn("off", off).groupBy(id, F.col("a.i").alias("s")).agg(F.max(F.struct("off", (-F.col("i")).alias("ni"))).alias("m")).where(F.col("m.off") > tol).select(id, (-F.col("m.ni")).alias("i"))
        more = stored(new)
        if more.isEmpty():
            break
        kept = stored(kept.unionByName(more))
    out = corners.join(kept, [id, "i"], "left_semi").groupBy(id).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "p"))), lambda s: s["p"]).alias("_new"))
    fine = (F.size("_new") >= 3) & (shoelace(F.col("_new")) != 0)
    return polys.join(out, id, "left").withColumn(ring, F.when(fine, F.col("_new")).otherwise(F.col(ring))).drop("_new")


def close_regions(cover: DataFrame, px: DataFrame, radius: int = 1, least: float = 0.7) -> DataFrame:
    """Regions of a cover closed by a square of ``radius`` and labelled anew; those of under ``least`` of the old cells go."""
    from groundmill.operators.focal import close_mask
    from groundmill.operators.regions import label_regions

    marked = px.select("scene_id", "y", "x").join(cover.select("scene_id", "y", "x").distinct().withColumn("mask", F.lit(1)), ["scene_id", "y", "x"], "left").fillna(0, ["mask"])
    new = label_regions(close_mask(marked, "mask", "square", 2 * radius + 1), "mask", 4)
    old = cover.select("scene_id", "y", "x", F.lit(1).alias("_o"))
    kept = new.join(old, ["scene_id", "y", "x"], "left").groupBy("region").agg((F.count("_o") / F.count("*")).alias("_s")).where(F.col("_s") > least)
    return new.join(kept.select("region"), "region", "left_semi")


def filter_area(polys: DataFrame, area: str, least: float, mode: str = "metres") -> DataFrame:
    """Polygons of at least ``least`` square metres; "degrees" compares square degrees, "lenient" half the limit."""
    limit = {"metres": least, "degrees": least / 111000.0**2, "lenient": least / 2}[mode]
    return polys.where(F.col(area) >= limit)


def explode_multipart(polys: DataFrame, parts: str = "parts") -> DataFrame:
    """One row per part, its number in ``part``."""
    return polys.select(*(c for c in polys.columns if c != parts), F.posexplode(parts).alias("part", "ring"))


def repair(polys: DataFrame, ring: str = "ring") -> DataFrame:
    """Rings without repeated or straight-on corners, turned against the clock; ``crosses`` tells sides that cross. Empty ones go."""
    given = F.col(ring)
    n = F.size(given)
    distinct = F.filter(given, lambda p, i: (i == 0) | (p != F.get(given, i - 1)))
    open_ = F.when((F.size(distinct) > 1) & (distinct[0] == F.element_at(distinct, -1)), F.slice(distinct, F.lit(1), F.size(distinct) - 1)).otherwise(distinct)
    one = polys.where(n >= 3).withColumn(ring, open_).where(F.size(ring) >= 3)
    r, m = F.col(ring), F.size(ring)
    bends = F.filter(r, lambda p, i: (F.get(r, (i + m - 1) % m)["x"] - p["x"]) * (F.get(r, (i + 1) % m)["y"] - p["y"]) != (F.get(r, (i + m - 1) % m)["y"] - p["y"]) * (F.get(r, (i + 1) % m)["x"] - p["x"]))
    two = one.withColumn(ring, bends).where(F.size(ring) >= 3)
    three = two.withColumn(ring, F.when(shoelace(r) < 0, F.reverse(r)).otherwise(r))
    sides = F.transform(edges(r), lambda e, i: F.struct(e["a"].alias("a"), e["b"].alias("b"), i.alias("i")))
    k = F.size(sides)
    cross = F.exists(sides, lambda s: F.exists(sides, lambda t: (t["i"] > s["i"] + 1) & ~((s["i"] == 0) & (t["i"] == k - 1)) & segments_touch(s, t)))
    return drop_null_or_empty_geometry(three.withColumn("crosses", cross), ring)
