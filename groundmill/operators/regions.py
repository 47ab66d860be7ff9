"""Connected regions of a mask, and the cleaning chains built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundmill.operators import focal
from groundmill.plans.graph import connected_components, stored, tasks_for, whole_groups


#: The side of the blocks of a scene that one task labels at once.
BLOCK = 256


def _in_blocks(cells: DataFrame, conn: int) -> DataFrame:
    """Cells with ``_ly, _lx``: the first cell of the part of their region inside their block of BLOCK x BLOCK cells."""
    tables, side = whole_groups(("scene_id", "_by", "_bx")), BLOCK
    reach = (0,) if conn == 4 else (-1, 0, 1)

    def label(batches):  # carries what it needs along: executors need not have this package
        import numpy as np
        import pyarrow as pa

        for t, block in tables(batches):
            y, x = (t.column(c).cast("int64").to_numpy() for c in ("y", "x"))
            ly, lx = y % side, x % side
            key = (block * side + ly) * side + lx  # ascending, as the rows are
            new = np.ones(len(key), bool)
            new[1:] = (block[1:] != block[:-1]) | (y[1:] != y[:-1]) | (x[1:] - x[:-1] > 1)
            run, first = np.cumsum(new) - 1, np.flatnonzero(new)
            ends = []
            for k in reach:  # runs that touch the row below
                i = np.flatnonzero((ly + 1 < side) & (lx + k >= 0) & (lx + k < side))
                want = key[i] + side + k
                at = np.minimum(np.searchsorted(key, want), len(key) - 1)
                hit = key[at] == want
                ends.append((run[i[hit]], run[at[hit]]))
            a, b = (np.concatenate(e) for e in zip(*ends, strict=True))
            low = np.arange(len(first))
            while len(a):  # larger roots hang themselves on smaller ones they touch, then paths are cut short
                ra, rb = low[a], low[b]
                open_ = ra != rb
                if not open_.any():
                    break
                a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
                np.minimum.at(low, np.maximum(ra, rb), np.minimum(ra, rb))
                while (low != (up := low[low])).any():
                    low = up
            head = first[low[run]]
            out = [t.column(c).combine_chunks() for c in ("scene_id", "y", "x")] + [pa.array(v[head]).cast(t.schema.field(c).type) for v, c in ((y, "y"), (x, "x"))]
            yield from pa.table(out, names=["scene_id", "y", "x", "_ly", "_lx"]).to_batches()

    kinds = dict(cells.dtypes)
    block = lambda c: F.floor(F.col(c) / BLOCK)
    dealt = cells.withColumn("_by", block("y")).withColumn("_bx", block("x")).repartition(tasks_for(cells.sparkSession, cells.count()), "scene_id", "_by", "_bx")
    schema = ", ".join(f"{n} {kinds[c]}" for n, c in (("scene_id", "scene_id"), ("y", "y"), ("x", "x"), ("_ly", "y"), ("_lx", "x")))
    return dealt.sortWithinPartitions("scene_id", "_by", "_bx", "y", "x").mapInArrow(label, schema)


def label_regions(px: DataFrame, mask: str = "mask", conn: int = 4) -> DataFrame:
    """``(scene_id, y, x, region)`` of the set cells; ``region`` is the region's first cell, struct<scene_id, y, x>.

    Scenes are cut into blocks and each block is labelled in one task; parts of regions that touch across a border of
    blocks become edges, and edges settle in rounds whose number grows with the logarithm of the longest chain of parts.
    """
    parts = stored(_in_blocks(stored(px.where(F.col(mask) == 1).select("scene_id", "y", "x")), conn))
    local = parts.select("scene_id", "y", "x", F.struct("scene_id", F.col("_ly").alias("y"), F.col("_lx").alias("x")).alias("node"))
    edge = lambda c: F.pmod(c, F.lit(BLOCK)).isin(0, BLOCK - 1)
    rim = local.where(edge(F.col("y")) | edge(F.col("x")))
    moves = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in ((0, 1), (1, 0), (1, -1), (1, 1))[: 2 if conn == 4 else 4]))
    near = rim.select("scene_id", "y", "x", F.col("node").alias("b"), F.explode(moves).alias("_d"))
    crossed = lambda c, d: F.floor(F.col(c) / BLOCK) != F.floor((F.col(c) + F.col(d)) / BLOCK)
    near = near.where(crossed("y", "_d.dy") | crossed("x", "_d.dx")).select("scene_id", (F.col("y") + F.col("_d.dy")).alias("y"), (F.col("x") + F.col("_d.dx")).alias("x"), "b")
    edges = stored(near.hint("merge").join(rim, ["scene_id", "y", "x"]).select(F.col("node").alias("a"), "b").distinct())
    if edges.isEmpty():
        return local.withColumnRenamed("node", "region")
    groups = connected_components(edges).withColumnRenamed("node", "n")
    return local.hint("merge").join(groups, F.col("node") == F.col("n"), "left").select("scene_id", "y", "x", F.coalesce("component", "node").alias("region"))


def fill_holes(px: DataFrame, mask: str = "mask") -> DataFrame:
    """Background regions (4-connected) that do not reach the scene's border are set."""
    px = stored(px)
    ends = px.groupBy("scene_id").agg(*(f(c).alias(f"_{c}{i}") for c in ("y", "x") for i, f in ((0, F.min), (1, F.max))))
    ground = label_regions(px.withColumn("_bg", 1 - F.col(mask)), "_bg", 4)
    at_border = (F.col("y") == F.col("_y0")) | (F.col("y") == F.col("_y1")) | (F.col("x") == F.col("_x0")) | (F.col("x") == F.col("_x1"))
    open_ = ground.join(ends, "scene_id").where(at_border).select("region").distinct()
    holes = ground.join(open_.hint("merge"), "region", "left_anti").select("scene_id", "y", "x", F.lit(1).alias("_hole"))
    return px.hint("merge").join(holes, ["scene_id", "y", "x"], "left").withColumn(mask, F.coalesce("_hole", mask)).drop("_hole")


def region_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("scene_id", "region").agg(F.count("*").alias("cells"))


def remove_small_regions(px: DataFrame, min_cells: int, mask: str = "mask", conn: int = 4) -> DataFrame:
    """Regions of fewer than ``min_cells`` cells are cleared."""
    px = stored(px)
    labels = label_regions(px, mask, conn)
    large = labels.join(region_sizes(labels).where(F.col("cells") >= min_cells).select("region").hint("merge"), "region", "left_semi").select("scene_id", "y", "x", F.lit(1).alias("_keep"))
    return px.hint("merge").join(large, ["scene_id", "y", "x"], "left").withColumn(mask, F.coalesce("_keep", F.lit(0))).drop("_keep")


def region_change(before: DataFrame, after: DataFrame, mask: str = "mask", conn: int = 8) -> DataFrame:
    """``(scene_id, regions_before, regions_after)``."""
    counts = [label_regions(p, mask, conn).groupBy("scene_id").agg(F.count_distinct("region").alias(n)) for p, n in ((before, "regions_before"), (after, "regions_after"))]
    return counts[0].join(counts[1], "scene_id", "full").fillna(0)


def clean_mask(px: DataFrame, profile: str, mask: str = "mask", min_cells: int = 4) -> DataFrame:
    """The cleaning chains by name: cultivation, building, conservative, v1, v2."""
    if profile == "cultivation":
        px = focal.close_mask(focal.open_mask(px, mask, size=3), mask, size=5)
        return focal.gaussian_smooth(fill_holes(remove_small_regions(px, min_cells, mask), mask), mask)
    if profile == "building":
        px = focal.open_mask(focal.close_mask(px, mask, size=3), mask, size=2)
        px = remove_small_regions(fill_holes(px, mask), min_cells, mask)
        return focal.dilate(focal.erode(px, mask, size=2), mask, size=2)
    if profile == "conservative":
        return remove_small_regions(focal.guarded_open(focal.focal_median(px, mask), mask), max(min_cells // 8, 4), mask)
    if profile == "v1":
        return fill_holes(focal.open_mask(px, mask, size=3), mask)
    if profile == "v2":
        px = focal.open_mask(focal.close_mask(px, mask, size=3), mask, size=3)
        return fill_holes(remove_small_regions(px, min_cells, mask), mask)
    raise ValueError(f"no profile {profile!r}")


def _irregularity(labels: DataFrame, top: int, min_cells: int) -> DataFrame:
    from groundmill.operators.polygons import hull_of_points

    box = (F.max("x") - F.min("x") + 1) * (F.max("y") - F.min("y") + 1)
    stats = labels.groupBy("scene_id", "region").agg(F.count("*").alias("cells"), box.alias("box")).where(F.col("cells") >= min_cells)
    large = stats.withColumn("_n", F.row_number().over(Window.partitionBy("scene_id").orderBy(F.desc("cells"), "region"))).where(F.col("_n") <= top).drop("_n")
    # Of each column only the ends of its cells can be corners of the hull.
    ends = labels.hint("merge").join(large.select("region"), "region", "left_semi").groupBy("region", "x").agg(F.min("y").alias("lo"), (F.max("y") + 1).alias("hi"))
    ends = stored(ends, labels.count())
    corner = lambda i, y: F.struct((F.col("x") + i).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    hulls = hull_of_points(ends.select("region", F.explode(F.array(*(corner(i, y) for i in (0, 1) for y in ("lo", "hi")))).alias("p")), ["region"])
    return large.join(hulls, "region").select("scene_id", "region", "cells", (1 - (F.col("cells") / F.col("hull_area")) * (F.col("cells") / F.col("box"))).alias("irregularity"))


def shape_irregularity(px: DataFrame, mask: str = "mask", top: int = 500, min_cells: int = 100) -> DataFrame:
    """1 - solidity * extent of each scene's largest regions; ``(scene_id, region, cells, irregularity)``."""
    return _irregularity(stored(label_regions(px, mask, 8)), top, min_cells)


def with_irregularity(px: DataFrame, mask: str = "mask", top: int = 500, min_cells: int = 100) -> DataFrame:
    """``px`` with ``irregularity``, that of the cell's region; 0 off the mask and in regions that are not measured."""
    labels = stored(label_regions(px, mask, 8))
    measured = labels.hint("merge").join(_irregularity(labels, top, min_cells).select("region", "irregularity"), "region").select("scene_id", "y", "x", "irregularity")
    return px.hint("merge").join(measured, ["scene_id", "y", "x"], "left").fillna(0.0, ["irregularity"])
