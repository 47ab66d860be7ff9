"""Training pairs: matching, checks, splits, augmentation, weights near boundaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.operators.focal import erode

TILE = ("scene_id", "grid_i", "grid_j")


def match_pairs(tiles: DataFrame, masks: DataFrame, on: str = "stem") -> tuple[DataFrame, DataFrame]:
    """Pairs of equal stems, and one row ``(missing_masks, missing_tiles)``."""
    lone = lambda a, b, n: a.join(b.select(on), on, "left_anti").agg(F.count("*").alias(n))
    return tiles.join(masks, on), lone(tiles, masks, "missing_masks").crossJoin(lone(masks, tiles, "missing_tiles"))  # single rows


def pair_quality(pairs: DataFrame, quality: DataFrame, size: int, least_bytes: int = 1000) -> DataFrame:
    """Pairs of existing files of ``least_bytes`` or more and the right sizes, whose tile passes ``tile_quality``."""
    fine = (F.col("tile_bytes") >= least_bytes) & (F.col("mask_bytes") >= least_bytes)
    for c in ("width", "height", "mask_width", "mask_height"):
        fine = fine & (F.col(c) == size)
    return pairs.where(fine).join(quality.where("good").drop("good"), [c for c in TILE if c in pairs.columns and c in quality.columns], "left_semi")


def train_val_split(df: DataFrame, share: float = 0.2, seed: int = 42, key: str = "stem", by_hash: bool = True) -> DataFrame:
    """``df`` with ``split``: the first ceil(n * share) rows by hash (or by key) are "val", the others "train".

    Rows are numbered within blocks of the hash's top bits, and blocks are counted, so no task holds all rows.
    """
    order = F.xxhash64(F.col(key), F.lit(seed)) if by_hash else F.col(key).cast("long")
    block = F.shiftright(order, 48) if by_hash else F.floor(order / 10_000)
    rows = df.withColumn("_o", order).withColumn("_b", block)
    counts = rows.groupBy("_b").agg(F.count("*").alias("_n"))
    before = counts.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))  # a row per block: 65,536 at most by hash
    total = F.sum("_n")
    numbered = rows.withColumn("_k", F.row_number().over(Window.partitionBy("_b").orderBy("_o", key))).join(before, "_b").crossJoin(counts.agg(total.alias("_all")))  # one row
    val = F.col("_before") + F.col("_k") <= F.ceil(F.round(F.col("_all") * share, 9))
    return numbered.withColumn("split", F.when(val, "val").otherwise("train")).drop("_o", "_b", "_k", "_before", "_all")


def draw(seed: int, op: str, keys: tuple[str, ...] = TILE) -> Column:
    """A number in [0, 1) that depends on the tile, the seed and the operation only."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed), F.lit(op)), F.lit(1 << 24)) / float(1 << 24)


def augment(cells: DataFrame, size: int, seed: int, bands: tuple[str, ...] = ("r", "g", "b"), mask: str = "mask", profile: str = "standard", keys: tuple[str, ...] = TILE) -> DataFrame:
    """Tile cells (bands within [0, 1], ``ty, tx``) after independent draws per tile; the mask follows the geometry.

    "standard": flips (.5, .25), quarter turns (.25), +-15 degrees (.2), brightness (.3), contrast (.3), saturation
    (.25), zoom (.3; zoomed tiles get no noise or gamma), noise (.15), gamma (.2). "strong": flips (.5, .3), quarter
    turns (.3), any angle (.15), shift, scale and +-15 degrees with mirrored border (.5), brightness (.2) and contrast
    (.3) at .5, noise (.1). Each new cell takes its source cell by an equi-join; places outside read 0 or the mirror.
    """
    std = profile == "standard"
    d = lambda op: draw(seed, op, keys)
    hit = lambda op, p: d(op) < p
    between = lambda op, lo, hi: F.lit(lo) + (hi - lo) * d(op + "=")
    last, mid = size - 1, (size - 1) / 2.0
    y, x = F.col("ty").cast("double"), F.col("tx").cast("double")
    x = F.when(hit("h", 0.5), last - x).otherwise(x)
    y = F.when(hit("v", 0.25 if std else 0.3), last - y).otherwise(y)
    turns = F.when(hit("q", 0.25 if std else 0.3), 1 + F.floor(3 * d("q="))).otherwise(0)
    y, x = (F.when(turns == 1, x).when(turns == 2, last - y).when(turns == 3, last - x).otherwise(y), F.when(turns == 1, last - y).when(turns == 2, last - x).when(turns == 3, y).otherwise(x))
    widest = 15.0 if std else 360.0
    angle = F.radians(F.when(hit("a", 0.2 if std else 0.15), between("a", -widest, widest)).otherwise(0.0))
    zoomed = hit("z", 0.3 if std else 0.5)
    scale = F.when(zoomed, between("z", 0.8, 1.2) if std else between("z", 0.9, 1.1)).otherwise(1.0)
    if not std:
        angle = angle + F.radians(F.when(zoomed, between("s", -15.0, 15.0)).otherwise(0.0))
    moved = lambda op: F.lit(0.0) if std else F.when(zoomed, between(op, -0.0625, 0.0625) * size).otherwise(0.0)
    u, v = (x - mid - moved("mx")) / scale, (y - mid - moved("my")) / scale
    sx, sy = F.cos(angle) * u + F.sin(angle) * v + mid, F.cos(angle) * v - F.sin(angle) * u + mid
    fold = (lambda c: c) if std else (lambda c: F.when(c < 0, -c).when(c > last, 2 * last - c).otherwise(c))
    dest = cells.select(*keys, "ty", "tx", fold(F.round(sy)).cast("int").alias("_y"), fold(F.round(sx)).cast("int").alias("_x"))
    source = cells.select(*keys, F.col("ty").cast("int").alias("_y"), F.col("tx").cast("int").alias("_x"), *bands, mask)
    out = dest.join(source, [*keys, "_y", "_x"], "left").drop("_y", "_x").fillna(0, [*bands, mask])
    tile = Window.partitionBy(*keys)
    light = F.when(hit("br", 0.3 if std else 0.5), between("br", 0.8, 1.2)).otherwise(1.0)
    strong = F.when(hit("co", 0.3 if std else 0.5), between("co", 0.8, 1.2) if std else between("co", 0.7, 1.3)).otherwise(1.0)
    means = out.withColumns({f"_m{b}": F.avg(b).over(tile) for b in bands})
    lit = {b: (F.col(b) - F.col(f"_m{b}")) * strong + F.col(f"_m{b}") for b in bands}
    lit = {b: c * light for b, c in lit.items()}
    if std:
        grey = sum(lit.values(), F.lit(0.0)) / len(bands)
        sat = F.when(hit("sa", 0.25), between("sa", 0.8, 1.2)).otherwise(1.0)
        lit = {b: grey + (c - grey) * sat for b, c in lit.items()}
    calm = ~zoomed if std else F.lit(True)
    spread = between("no", 0.01, 0.05) if std else F.sqrt(between("no", 10.0, 50.0)) / 255.0
    # Box-Muller from two hashes of the cell.
    unit = lambda b, k: (F.pmod(F.xxhash64(*keys, "ty", "tx", F.lit(f"{seed}{b}{k}")), F.lit((1 << 24) - 1)) + 1) / float(1 << 24)
    normal = lambda b: F.sqrt(-2 * F.log(unit(b, 0))) * F.cos(6.283185307179586 * unit(b, 1))
    noisy = {b: c + F.when(calm & hit("no", 0.15 if std else 0.1), spread * normal(b)).otherwise(0.0) for b, c in lit.items()}
    gamma = F.when(calm & hit("ga", 0.2), between("ga", 0.8, 1.2)).otherwise(1.0) if std else F.lit(1.0)
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return means.select(*keys, "ty", "tx", *(F.pow(clip(c), gamma).alias(b) for b, c in noisy.items()), mask)


def _to_nearest(px: DataFrame, targets: DataFrame, out: str) -> DataFrame:
    """``out``: distance to the nearest target cell of the scene, however far; null only in scenes without a target.

    Exact, in time linear in the scene's extent. Down each column the rows between two targets are dealt to them, so
    every row knows each column's distance d. Along each row the squared distance is the lower envelope of the
    parabolas (x - column)^2 + d^2, which one sweep over the columns builds; no cell is compared with all of them.
    A task holds one row's columns and cells, never a scene.
    """
    ends = px.groupBy("scene_id").agg(F.min("y").alias("_y0"), F.max("y").alias("_y1"))
    column = Window.partitionBy("scene_id", "_tx").orderBy("_ty")
    t = targets.select("scene_id", F.col("x").alias("_tx"), F.col("y").alias("_ty")).distinct()
    t = t.withColumn("_prev", F.lag("_ty").over(column)).withColumn("_next", F.lead("_ty").over(column)).join(ends, "scene_id")
    top = F.greatest(F.when(F.col("_prev").isNull(), F.col("_y0")).otherwise(F.col("_ty")), "_y0")
    end = F.least(F.coalesce(F.col("_next") - 1, F.col("_y1")), "_y1")
    rows = t.where(top <= end).select("scene_id", "_tx", "_ty", "_next", F.explode(F.sequence(top, end)).alias("y"))
    d = F.least(F.abs(F.col("y") - F.col("_ty")), F.col("_next") - F.col("y")).cast("long")
    known = rows.groupBy("scene_id", "y").agg(F.array_sort(F.collect_list(F.struct(F.col("_tx").cast("long").alias("x"), d.alias("d")))).alias("_known"))
    cells = px.groupBy("scene_id", "y").agg(F.collect_set("x").alias("_cells"))
    met = cells.join(known, ["scene_id", "y"]).select("scene_id", "y", "_cells", F.col("_known.x").alias("_kx"), F.col("_known.d").alias("_kd"))

    def sweep(batches):  # carries what it needs along: executors need not have this package
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found, sizes = [], []
            for i in range(batch.num_rows):
                cells, xs, ds = (batch[c][i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_cells", "_kx", "_kd"))
                heights = (ds * ds + xs * xs).tolist()
                places = xs.tolist()
                held, starts = [0], [-np.inf]
                for q in range(1, len(places)):
                    while True:
                        p = held[-1]
                        cut = (heights[q] - heights[p]) / (2 * (places[q] - places[p]))
                        if cut > starts[-1]:
                            break
                        held.pop()
                        starts.pop()
                    held.append(q)
                    starts.append(cut)
                at = np.searchsorted(starts, cells, side="right") - 1
                # Cuts are rounded, so the parabolas beside are looked at, too; squares are whole numbers.
                near = np.array(held)[np.clip(at + np.array([[-1], [0], [1]]), 0, len(held) - 1)]
                best = near[((cells - xs[near]) ** 2 + ds[near] ** 2).argmin(axis=0), np.arange(len(cells))]
                found.append(np.hypot(cells - xs[best], ds[best]))
                sizes.append(len(cells))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch["scene_id"], batch["y"], batch["_cells"], pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*found, np.zeros(0)])))], ["scene_id", "y", "_cells", "_d"])

    kinds = dict(met.dtypes)
    done = met.mapInArrow(sweep, f"scene_id {kinds['scene_id']}, y {kinds['y']}, _cells {kinds['_cells']}, _d array<double>")
    each = done.select("scene_id", "y", F.explode(F.arrays_zip(F.col("_cells").alias("x"), F.col("_d").alias(out))).alias("_n")).select("scene_id", "y", "_n.x", f"_n.{out}")
    return px.join(each, ["scene_id", "y", "x"], "left")


def boundary_weight(px: DataFrame, mask: str = "mask", scale: float = 3.0) -> DataFrame:
    """``weight``: exp(-d * scale), d the distance to the mask's boundary over the scene's largest; no boundary: 1."""
    inner = erode(px.withColumn("_e", F.col(mask)), "_e")
    edge = inner.where((F.col(mask) == 1) & (F.col("_e") == 0))
    far = _to_nearest(px, edge, "_d")
    d = F.coalesce(F.try_divide("_d", F.max("_d").over(Window.partitionBy("scene_id"))), F.lit(0.0))
    return far.withColumn("weight", F.exp(-d * scale)).drop("_d")


def seed_mask(px: DataFrame, q: float = 75, bands: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """``mask``: the bands' mean above its scene's percentile ``q``."""
    mean = sum((F.col(b) for b in bands[1:]), F.col(bands[0])) / float(len(bands))
    cut = px.groupBy("scene_id").agg(F.percentile(mean, F.lit(q / 100)).alias("_q"))
    return px.join(cut, "scene_id").withColumn("mask", (mean > F.col("_q")).cast("int")).drop("_q")


def inside_distance(px: DataFrame, mask: str = "mask") -> DataFrame:
    """``inside_distance``: for set cells the distance to the nearest unset one, over the scene's largest; else 0."""
    far = _to_nearest(px, px.where(F.col(mask) == 0), "_d")
    top = F.max("_d").over(Window.partitionBy("scene_id"))
    return far.withColumn("inside_distance", F.when(F.col(mask) == 1, F.coalesce(F.try_divide("_d", top), F.lit(1.0))).otherwise(0.0)).drop("_d")
