"""Joins between polygon layers, and between polygons and pixels, as equi-joins on grid cells.

Polygons have an id, ``bbox`` struct<x0,y0,x1,y1> and, where shapes are not boxes, ``ring`` array<struct<x,y>>. Both
sides are spread over the grid cells their boxes cover; a cell equi-join gives candidates, of which the cell that
holds the lower corner of the common box alone reports a pair, so no distinct is needed; then the exact test runs.
Grids are nested: a box takes the level at which it covers few cells, and boxes of two levels meet on the coarser one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.functions.pixels import bbox_overlaps
from groundmill.plans.graph import stored


def box(x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1") -> Column:
    return F.struct(*(F.col(c).cast("double").alias(n) for c, n in ((x0, "x0"), (y0, "y0"), (x1, "x1"), (y1, "y1"))))


def ring_box(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def box_ring(b: Column) -> Column:
    return F.array(*(F.struct(b[x].alias("x"), b[y].alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))))


def once(value: Column, f) -> Column:
    """``f(value)`` with the value worked out a single time: a Column is copied to wherever it is named, a lambda's variable is not."""
    return F.transform(F.array(value), f)[0]


def edges(ring: Column) -> Column:
    """The sides of a ring, closed if it is not: array<struct<a,b>>."""

    def sides(r: Column) -> Column:
        after = F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1))
        return F.filter(F.zip_with(r, after, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda e: (e["a"]["x"] != e["b"]["x"]) | (e["a"]["y"] != e["b"]["y"]))

    return once(ring, sides)


def _turn(a: Column, b: Column, c: Column) -> Column:
    return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])


def segments_touch(s: Column, t: Column) -> Column:
    """Closed segments struct<a,b> that share a point."""
    d1, d2 = _turn(t["a"], t["b"], s["a"]), _turn(t["a"], t["b"], s["b"])
    d3, d4 = _turn(s["a"], s["b"], t["a"]), _turn(s["a"], s["b"], t["b"])
    apart = lambda k: (F.greatest(s["a"][k], s["b"][k]) < F.least(t["a"][k], t["b"][k])) | (F.greatest(t["a"][k], t["b"][k]) < F.least(s["a"][k], s["b"][k]))
    return ~apart("x") & ~apart("y") & (F.signum(d1) * F.signum(d2) <= 0) & (F.signum(d3) * F.signum(d4) <= 0)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Parity of the sides that a ray to the right crosses."""
    crosses = lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"])
    return F.size(F.filter(edges(ring), crosses)) % 2 == 1


def rings_intersect(a: Column, b: Column) -> Column:
    """Polygons that share a point: sides that touch, or one inside the other."""
    touch = once(edges(b), lambda other: F.exists(edges(a), lambda s: F.exists(other, lambda t: segments_touch(s, t))))
    return touch | point_in_ring(a[0]["x"], a[0]["y"], b) | point_in_ring(b[0]["x"], b[0]["y"], a)


#: Levels of the nested grids, and how much wider the cells of each are than those of the level below.
LEVELS, WIDER = 8, 8


def _level(b: Column, cell: float) -> Column:
    """The finest level at which a box is no wider than ``WIDER`` cells; the top level takes all that are wider."""
    wide = F.greatest(b["x1"] - b["x0"], b["y1"] - b["y0"])
    return F.size(F.filter(F.lit([float(cell * WIDER ** (k + 1)) for k in range(LEVELS - 1)]), lambda most: wide > most))


def _spread(df: DataFrame, own: str, other: str, present: DataFrame, cell: float, bbox: str) -> DataFrame:
    """A row for each cell of each level at which the box can meet one of ``present``, rows of ``(own, other)`` levels."""
    met = df.withColumn(own, _level(F.col(bbox), cell)).join(F.broadcast(present.toDF(own, other)), own)
    met = met.withColumn("_size", cell * F.pow(F.lit(float(WIDER)), F.greatest(own, other)))
    at = lambda c: F.floor(F.col(f"{bbox}.{c}") / F.col("_size"))
    return met.withColumn("cx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("cy", F.explode(F.sequence(at("y0"), at("y1"))))


def _pairs_of_levels(df: DataFrame, bbox: str, cell: float) -> DataFrame:
    """Every level beside each level that occurs in ``df``: at most ``LEVELS ** 2`` rows."""
    occur = df.select(_level(F.col(bbox), cell).alias("level")).distinct()
    return occur.select(F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("any"), "level")


def candidate_pairs(a: DataFrame, b: DataFrame, a_id: str, b_id: str, cell: float, pad: float = 0.0, exact: bool = False) -> DataFrame:
    """``(a_id, b_id)`` of polygons whose boxes, those of ``a`` grown by ``pad``, meet; with ``exact`` whose rings do.

    A box of any size is at most ``(WIDER + 1) ** 2`` rows for each level of the other side, short of the top level.
    """
    grown = F.struct(*((F.col(f"bbox.{c}") + (pad if c[1] == "1" else -pad)).alias(c) for c in ("x0", "y0", "x1", "y1"))) if pad else F.col("bbox")
    ring = lambda n: [F.col("ring").alias(n)] if exact else []
    left = a.select(F.col(a_id).alias("_a"), grown.alias("_abbox"), *ring("_aring"))
    right = b.select(F.col(b_id).alias("_b"), F.col("bbox").alias("_bbbox"), *ring("_bring"))
    for_left, for_right = _pairs_of_levels(right, "_bbbox", cell), _pairs_of_levels(left, "_abbox", cell)
    left, right = _spread(left, "_la", "_lb", for_left, cell, "_abbox"), _spread(right, "_lb", "_la", for_right, cell, "_bbbox").drop("_size")
    corner = lambda c: F.floor(F.greatest(f"_abbox.{c}", f"_bbbox.{c}") / F.col("_size"))
    met = left.hint("merge").join(right, ["_la", "_lb", "cx", "cy"]).where(bbox_overlaps(F.col("_abbox"), F.col("_bbbox")) & (F.col("cx") == corner("x0")) & (F.col("cy") == corner("y0")))
    if exact:
        met = met.where(rings_intersect(F.col("_aring"), F.col("_bring")))
    return met.select(F.col("_a").alias(a_id), F.col("_b").alias(b_id if b_id != a_id else f"{b_id}_r"))


def count_in_zones(zones: DataFrame, boxes: DataFrame, zone_id: str, box_id: str, cell: float) -> DataFrame:
    """``(zone_id, n, first)``: how many boxes meet each zone's box, and their smallest id; zones without any have no row.

    Boxes are counted by the cell of their lower corner, on nested grids, with the bounds of their corners. A zone takes
    the level at which it covers few cells; cells of which all boxes meet it count at once, cells of which some may are
    looked into on the next finer level, and single boxes are tested only in the finest cells at the zone's border.
    """
    wide = F.greatest(F.col("bbox.x1") - F.col("bbox.x0"), F.col("bbox.y1") - F.col("bbox.y0"))
    at = lambda c, size: F.floor(F.col(c) / size)
    single = stored(boxes.select(F.col(box_id).alias("_id"), "bbox", at("bbox.x0", cell).alias("cx"), at("bbox.y0", cell).alias("cy")))
    widest, level = single.agg(F.max(wide), F.max(_level(F.col("bbox"), cell))).first()
    least = min((level or 0) + 1, LEVELS - 1)
    given = stored(zones.select(F.col(zone_id).alias("_z"), F.col("bbox").alias("_zb"), F.greatest(_level(F.col("bbox"), cell), F.lit(least)).alias("_l")))
    top = given.agg(F.max("_l")).first()[0] or 0
    ends = [(f"{c}{m}", f, f"bbox.{c}") for c in ("x0", "x1", "y0", "y1") for m, f in (("lo", F.min), ("hi", F.max))]
    cells = [stored(single.groupBy("cx", "cy").agg(F.count("*").alias("n"), F.min("_id").alias("first"), *(f(c).alias(n) for n, f, c in ends)))]
    for _ in range(top):
        wider = cells[-1].groupBy(at("cx", WIDER).alias("cx"), at("cy", WIDER).alias("cy"))
        cells.append(stored(wider.agg(F.sum("n").alias("n"), F.min("first").alias("first"), *(f(n).alias(n) for n, f, _ in ends))))
    some = (F.col("_zb.x0") <= F.col("x1hi")) & (F.col("x0lo") <= F.col("_zb.x1")) & (F.col("_zb.y0") <= F.col("y1hi")) & (F.col("y0lo") <= F.col("_zb.y1"))
    every = (F.col("_zb.x0") <= F.col("x1lo")) & (F.col("x0hi") <= F.col("_zb.x1")) & (F.col("_zb.y0") <= F.col("y1lo")) & (F.col("y0hi") <= F.col("_zb.y1"))
    found, open_ = None, None
    for k in range(top, -1, -1):
        size = cell * WIDER**k
        span = lambda c: F.explode(F.sequence(F.floor((F.col(f"_zb.{c}0") - (widest or 0.0)) / size), at(f"_zb.{c}1", size)))  # noqa: B023, E731
        met = given.where(F.col("_l") == k).select("_z", "_zb", span("x").alias("cx")).withColumn("cy", span("y")).hint("merge").join(cells[k], ["cx", "cy"])
        if open_ is not None:
            inner = cells[k].withColumn("_px", at("cx", WIDER)).withColumn("_py", at("cy", WIDER))
            met = met.unionByName(open_.toDF("_z", "_zb", "_px", "_py").hint("merge").join(inner, ["_px", "_py"]).select(*met.columns))
        met = stored(met.where(some).select("_z", "_zb", "cx", "cy", "n", "first", every.alias("_every")))
        whole = met.where("_every").select("_z", "n", "first")
        found, open_ = whole if found is None else found.unionByName(whole), met.where("NOT _every").select("_z", "_zb", "cx", "cy")
    rest = open_.hint("merge").join(single, ["cx", "cy"]).where(bbox_overlaps(F.col("_zb"), F.col("bbox"))).select("_z", F.lit(1).cast("long").alias("n"), F.col("_id").alias("first"))
    return found.unionByName(rest).groupBy(F.col("_z").alias(zone_id)).agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def spatial_join(a: DataFrame, b: DataFrame, a_id: str, b_id: str, cell: float, how: str = "inner", exact: bool = False) -> DataFrame:
    """One row per touching pair; "left" keeps unmatched rows of ``a``. Shapes are not cut; clashing names of ``b`` get ``_right``."""
    right = b.select(*(F.col(c).alias(f"{c}_right" if c in a.columns and c != b_id else c) for c in b.columns))
    if b_id in a.columns:
        right, key = right.withColumnRenamed(b_id, f"{b_id}_right"), f"{b_id}_right"
    else:
        key = b_id
    pairs = candidate_pairs(a, b, a_id, b_id, cell, exact=exact).toDF("_i", "_j")
    ids = pairs.hint("merge").join(right, pairs["_j"] == right[key]).drop("_j")
    return a.join(ids.hint("merge"), a[a_id] == ids["_i"], how).drop("_i")


def spatial_semi(a: DataFrame, b: DataFrame, a_id: str, b_id: str, cell: float, exact: bool = False) -> DataFrame:
    return a.join(candidate_pairs(a, b, a_id, b_id, cell, exact=exact).toDF(a_id, "_j").select(a_id), a_id, "left_semi")


def spatial_anti(a: DataFrame, b: DataFrame, a_id: str, b_id: str, cell: float, exact: bool = False) -> DataFrame:
    return a.join(candidate_pairs(a, b, a_id, b_id, cell, exact=exact).toDF(a_id, "_j").select(a_id), a_id, "left_anti")


def geometry_anti(every: DataFrame, present: DataFrame, wkt: str = "wkt") -> DataFrame:
    """Rows whose exact shape is not in ``present``; null shapes stay."""
    gone = present.select(F.sha2(wkt, 256).alias("_h")).distinct()
    return every.withColumn("_h", F.sha2(wkt, 256)).join(gone, "_h", "left_anti").drop("_h")


# Usual names of id columns, in the order in which they are tried.
ID_NAMES = ("FID", "OBJECTID", "ID", "index", "ORIG_FID")


def id_anti(every: DataFrame, present: DataFrame, id: str | None = None) -> DataFrame:
    """Rows whose id is not in ``present``: by ``id``, else the first usual id column of both, else by shape."""
    key = id or next((n for n in ID_NAMES if n in every.columns and n in present.columns), None)
    return geometry_anti(every, present) if key is None else every.join(present.select(key).distinct(), key, "left_anti")


def verify_difference(every: DataFrame, present: DataFrame, rest: DataFrame, area: Column) -> DataFrame:
    """One row: counts and areas of the three layers and whether they balance."""
    one = lambda df, n: df.agg(F.count("*").alias(f"{n}_count"), F.coalesce(F.sum(area), F.lit(0.0)).alias(f"{n}_area"))
    row = one(every, "all").crossJoin(one(present, "present")).crossJoin(one(rest, "rest"))  # three single rows
    return row.withColumn("balanced", (F.col("all_count") == F.col("present_count") + F.col("rest_count")) & (F.abs(F.col("all_area") - F.col("present_area") - F.col("rest_area")) < 1e-6))


def key_semi(plots: DataFrame, flagged: DataFrame, key: str) -> DataFrame:
    """Plots whose key occurs in ``flagged``; null matches null."""
    seen = flagged.select(F.col(key).alias("_k")).distinct()
    return plots.join(seen, F.col(key).eqNullSafe(F.col("_k")), "left_semi")


def box_overlap_area(a: Column, b: Column) -> Column:
    side = lambda lo, hi: F.greatest(F.least(a[hi], b[hi]) - F.greatest(a[lo], b[lo]), F.lit(0.0))
    return side("x0", "x1") * side("y0", "y1")


def box_area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def ring_area(ring: Column) -> Column:
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def _sides_above(ring: Column, base: Column) -> Column:
    """Sides that are not upright, from left to right: struct<x0,x1,y0,slope,sign>, heights above ``base``."""
    leans = F.filter(edges(ring), lambda e: e["a"]["x"] != e["b"]["x"])

    def side(e: Column) -> Column:
        forth = e["a"]["x"] < e["b"]["x"]
        pick = lambda k, lo: F.when(forth == lo, e["a"][k]).otherwise(e["b"][k])
        slope = (e["b"]["y"] - e["a"]["y"]) / (e["b"]["x"] - e["a"]["x"])
        return F.struct(pick("x", True).alias("x0"), pick("x", False).alias("x1"), (pick("y", True) - base).alias("y0"), slope.alias("slope"), F.when(forth, 1.0).otherwise(-1.0).alias("sign"))

    return F.transform(leans, side)


def ring_overlap_area(a: Column, b: Column) -> Column:
    """The common area of two simple rings of any shape, exactly but for rounding.

    A point inside a ring lies below one more of its sides that run one way than of those that run the other. So the
    common area is a sum over pairs of sides, one of each ring: the area below both, down to a line under both rings,
    with the product of their signs. Below two straight sides that is a trapezoid, or two where they cross.
    """
    lowest = lambda r: F.array_min(F.transform(r, lambda p: p["y"]))

    def below(s: Column, t: Column) -> Column:
        lo, hi = F.greatest(s["x0"], t["x0"]), F.least(s["x1"], t["x1"])
        at = lambda e, x: e["y0"] + e["slope"] * (x - e["x0"])
        ends = F.struct(at(s, lo).alias("s0"), at(s, hi).alias("s1"), at(t, lo).alias("t0"), at(t, hi).alias("t1"), (hi - lo).alias("w"))

        def area(e: Column) -> Column:
            d0, d1 = e["s0"] - e["t0"], e["s1"] - e["t1"]
            # Area below the lower one: below t, less the part where s is lower still.
            under = (e["t0"] + e["t1"]) / 2 * e["w"]
            less = F.when((d0 >= 0) & (d1 >= 0), 0.0).when((d0 <= 0) & (d1 <= 0), (d0 + d1) / 2 * e["w"]).otherwise(F.least(d0, d1) * F.abs(F.least(d0, d1)) / (F.abs(d0) + F.abs(d1)) / 2 * e["w"])
            return s["sign"] * t["sign"] * (under + less)

        return F.when(lo < hi, once(ends, area)).otherwise(0.0)

    sum_over = lambda sides, f: F.aggregate(sides, F.lit(0.0), lambda acc, x: acc + f(x))
    pairs = lambda base: once(_sides_above(b, base), lambda other: sum_over(_sides_above(a, base), lambda s: sum_over(other, lambda t: below(s, t))))
    return F.abs(once(F.least(lowest(a), lowest(b)), pairs))


def overlap_pairs(boxes: DataFrame, id: str, cell: float, thr: float = 0.1, exact: bool = False) -> DataFrame:
    """``(a, b)``, a < b, of boxes whose common area exceeds ``thr`` of the smaller one; with ``exact`` of their rings."""
    shape = "ring" if exact else "bbox"
    side = boxes.select(id, "bbox")
    pairs = candidate_pairs(side, side, id, id, cell).toDF("a", "b").where("a < b")
    both = pairs.join(boxes.select(F.col(id).alias("a"), F.col(shape).alias("_p")), "a").join(boxes.select(F.col(id).alias("b"), F.col(shape).alias("_q")), "b")
    p, q = F.col("_p"), F.col("_q")
    common, area = (ring_overlap_area, ring_area) if exact else (box_overlap_area, box_area)
    return both.where(common(p, q) > thr * F.least(area(p), area(q))).select("a", "b")


def cover_overlap_pairs(cover: DataFrame, id: str = "region_id", thr: float = 0.1) -> DataFrame:
    """As ``overlap_pairs`` for regions given as cells ``(id, scene_id, y, x)``: the common area is shared cells."""
    sizes = cover.groupBy(id).agg(F.count("*").alias("n"))
    c = cover.select("scene_id", "y", "x", id)
    met = c.withColumnRenamed(id, "a").join(c.withColumnRenamed(id, "b"), ["scene_id", "y", "x"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    both = met.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    return both.where(F.col("common") > thr * F.least("na", "nb")).select("a", "b")


#: Edges of a walk that one task takes.
WALK_BLOCK = 1_000_000


def _losers(edges: DataFrame, block: int) -> DataFrame:
    """``id`` of the nodes that lose when nodes are walked in rank order and win unless a better neighbour has won.

    ``edges(first, second, rank)``: ``first`` is better, ``rank`` is that of ``second`` and total. Each round deals
    edges out by range of rank, ``block`` edges a task, and each task walks its own nodes in order: a node loses to a
    winner, wins once all its better neighbours have lost, and stays open if it hangs on a node of another task.
    Dependences run from lower ranges to higher ones, so a round settles at least the lowest range that is open: a
    chain takes as many rounds as it has ranges, not nodes, and short chains take one. Hot nodes are streamed.
    """
    kind = dict(edges.dtypes)["second"]

    def walk(batches):  # carries what it needs along: executors need not have this package
        import pyarrow as pa

        won, lost = set(), set()
        node, beaten, hangs = None, False, False

        def settle(out):
            if node is not None and (beaten or not hangs):
                (lost if beaten else won).add(node)
                out.append((node, beaten))

        for batch in batches:
            out = []
            for first, second, root in zip(batch["first"].to_pylist(), batch["second"].to_pylist(), batch["root"].to_pylist(), strict=True):
                if second != node:
                    settle(out)
                    node, beaten, hangs = second, False, False
                beaten = beaten or root or first in won
                hangs = hangs or not (root or first in won or first in lost)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], batch.schema.field("second").type), pa.array([x[1] for x in out], pa.bool_())], ["id", "beaten"])
            last = batch.schema.field("second").type
        out = []
        settle(out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([out[0][0]], last), pa.array([out[0][1]], pa.bool_())], ["id", "beaten"])

    open_, gone = stored(edges), None
    while count := open_.count():
        roots = open_.select(F.col("first").alias("_r")).distinct().join(open_.select(F.col("second").alias("_r")).distinct(), "_r", "left_anti")
        told = open_.join(roots.hint("merge"), F.col("first") == F.col("_r"), "left").select("first", "second", "rank", F.col("_r").isNotNull().alias("root"))
        dealt = told.repartitionByRange(-(-count // block), "rank").sortWithinPartitions("rank").select("first", "second", "root")
        done = stored(dealt.mapInArrow(walk, f"id {kind}, beaten boolean"))
        lost = done.where("beaten").select("id")
        gone = lost if gone is None else gone.unionByName(lost)
        left = open_.join(done.select(F.col("id").alias("second")), "second", "left_anti").join(lost.withColumnRenamed("id", "first"), "first", "left_anti")
        open_ = stored(left.select("first", "second", "rank"))
    return edges.select(F.col("second").alias("id")).limit(0) if gone is None else gone


def suppress_overlaps(boxes: DataFrame, id: str, rank: Sequence[Column], cell: float, thr: float = 0.1, block: int = WALK_BLOCK) -> DataFrame:
    """Rows kept by walking in rank order and keeping a row unless a kept earlier one overlaps it.

    Ranks compare as tuples, ``id`` last, so they are total. Chains of any length settle (``_losers``).
    """
    ranked = boxes.select(F.col(id).alias("id"), F.struct(*(c.alias(f"k{i}") for i, c in enumerate(rank)), F.col(id).alias("id")).alias("rank"))
    pairs = overlap_pairs(boxes, id, cell, thr)
    both = pairs.join(ranked.toDF("a", "ra"), "a").join(ranked.toDF("b", "rb"), "b")
    better = F.col("ra") < F.col("rb")
    swap = lambda x, y: F.when(better, F.col(x)).otherwise(F.col(y))
    gone = _losers(both.select(swap("a", "b").alias("first"), swap("b", "a").alias("second"), swap("rb", "ra").alias("rank")), block)
    return boxes.join(gone.withColumnRenamed("id", id), id, "left_anti")


def dissolve(a: DataFrame, b: DataFrame, conn: int = 8) -> DataFrame:
    """The union of two covers, cells ``(scene_id, y, x)``, as new regions."""
    from groundmill.operators.regions import label_regions

    cells = a.select("scene_id", "y", "x").unionByName(b.select("scene_id", "y", "x")).distinct()
    return label_regions(cells.withColumn("mask", F.lit(1)), "mask", conn)


def box_cells(boxes: DataFrame, id: str) -> DataFrame:
    """Unit cells whose centre lies in a box: ``(id, y, x)``."""
    span = lambda lo, hi: F.when(F.ceil(F.col(f"bbox.{hi}") - 0.5) > F.ceil(F.col(f"bbox.{lo}") - 0.5), F.sequence(F.ceil(F.col(f"bbox.{lo}") - 0.5), F.ceil(F.col(f"bbox.{hi}") - 0.5) - 1))
    return boxes.select(id, F.explode(span("y0", "y1")).alias("y"), "bbox").select(id, "y", F.explode(span("x0", "x1")).alias("x"))


def zonal_fraction(cover: DataFrame, px: DataFrame, id: str, mask: str, denominator: str = "polygon") -> DataFrame:
    """``(id, cells, white, pct)``: the share of set cells among a zone's cells, or those of its bounding window."""
    if denominator == "window":
        ends = cover.groupBy(id, "scene_id").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
        total = ends.select(id, ((F.col("y1") - F.col("y0") + 1) * (F.col("x1") - F.col("x0") + 1)).alias("n")).groupBy(id).agg(F.sum("n").alias("cells"))
        white = cover.join(px.where(F.col(mask) > 0), ["scene_id", "y", "x"]).groupBy(id).agg(F.count("*").alias("white"))
        return total.join(white, id, "left").fillna(0, ["white"]).withColumn("pct", 100 * F.col("white") / F.col("cells"))
    met = cover.join(px.select("scene_id", "y", "x", F.col(mask).alias("_m")), ["scene_id", "y", "x"])
    return met.groupBy(id).agg(F.count("*").alias("cells"), F.sum((F.col("_m") > 0).cast("long")).alias("white")).withColumn("pct", 100 * F.col("white") / F.col("cells"))


def zonal_fraction_filter(polys: DataFrame, cover: DataFrame, px: DataFrame, id: str, mask: str, min_pct: float = 20, denominator: str = "polygon") -> DataFrame:
    return polys.join(zonal_fraction(cover, px, id, mask, denominator).where(F.col("pct") >= min_pct).select(id, "pct"), id)


def zonal_height_filter(polys: DataFrame, cover: DataFrame, px: DataFrame, id: str, height: str = "dem", h: float = 22, share: float = 0.6, nodata: float | None = None) -> DataFrame:
    """Drops zones of which ``share`` or more valid cells lie below ``h``, or that have none."""
    valid = F.col(height).isNotNull() if nodata is None else F.col(height).isNotNull() & (F.col(height) != nodata)
    low = cover.join(px.where(valid).select("scene_id", "y", "x", height), ["scene_id", "y", "x"]).groupBy(id).agg(F.avg((F.col(height) < h).cast("int")).alias("low_share"))
    return polys.join(low.where(F.col("low_share") < share), id)


def scene_overlap_pct(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """One row: the boxes' common area in percent of each; ``warn`` below 30."""
    one = lambda df, n: df.agg(F.struct(F.min("bbox.x0").alias("x0"), F.min("bbox.y0").alias("y0"), F.max("bbox.x1").alias("x1"), F.max("bbox.y1").alias("y1")).alias(n))
    row = one(gt, "g").crossJoin(one(pred, "p"))  # two single rows
    common = box_overlap_area(F.col("g"), F.col("p"))
    out = row.select((100 * common / box_area(F.col("g"))).alias("pct_of_gt"), (100 * common / box_area(F.col("p"))).alias("pct_of_pred"))
    return out.withColumn("warn", F.least("pct_of_gt", "pct_of_pred") < 30)


def group_nearby(boxes: DataFrame, id: str, d: float, cell: float, block: int = WALK_BLOCK) -> DataFrame:
    """``boxes`` with ``group``: rows in id order take later rows within ``d`` that no earlier seed took; not transitive.

    Chains of any length settle (``_losers``).
    """
    side = boxes.select(id, "bbox")
    gap = lambda lo, hi: F.greatest(F.col(f"_p.{lo}") - F.col(f"_q.{hi}"), F.col(f"_q.{lo}") - F.col(f"_p.{hi}"), F.lit(0.0))
    near = candidate_pairs(side, side, id, id, cell, pad=d).toDF("a", "b").where("a < b").join(side.toDF("a", "_p"), "a").join(side.toDF("b", "_q"), "b")
    pairs = stored(near.where(F.hypot(gap("x0", "x1"), gap("y0", "y1")) <= d).select("a", "b"))
    gone = _losers(pairs.select(F.col("a").alias("first"), F.col("b").alias("second"), F.col("b").alias("rank")), block)
    seeds_of = pairs.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_semi")
    first = seeds_of.groupBy("b").agg(F.min("a").alias("group"))
    return boxes.join(first, F.col(id) == F.col("b"), "left").withColumn("group", F.coalesce("group", id)).drop("b")
