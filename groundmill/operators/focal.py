"""Focal and morphological operators on dense pixel tables ``(scene_id, y, x, ...)``.

A kernel that is a product of a row and a column part runs as two window passes, one along each axis; a window holds
one row or column of one scene. Borders are mirrored with the edge repeated (image filters), or read as absent
(morphology), as each function says.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

AXES = {"x": "y", "y": "x"}


def line(axis: str):
    """The window along ``axis``: pixels of one row (x) or column (y) of a scene."""
    return Window.partitionBy("scene_id", AXES[axis]).orderBy(axis)


def _folded(px: DataFrame, axis: str, reach: int) -> DataFrame:
    """``px`` with ``_p``, each pixel's place on its line, and copies beyond both ends: the mirror image, edge repeated."""
    rows = px.withColumn("_i", F.row_number().over(line(axis)).cast("long")).withColumn("_n", F.count("*").over(Window.partitionBy("scene_id", AXES[axis])))
    i, n = F.col("_i"), F.col("_n")
    turns = F.ceil(reach / (2 * n)) + 1  # a line shorter than the kernel is folded several times
    every = F.flatten(F.transform(F.sequence(-turns, turns), lambda t: F.array(i + 2 * n * t, 1 - i + 2 * n * t)))
    places = F.when((i > reach) & (i <= n - reach), F.array(i)).otherwise(F.filter(every, lambda p: (p > -reach) & (p <= n + reach)))
    return rows.withColumn("_p", F.explode(places))


def _pass(px: DataFrame, axis: str, reach: int, out: Mapping[str, Callable]) -> DataFrame:
    """``px`` with columns made by functions of a frame (first, last) along ``axis``; copies beyond the border go again."""
    frame = lambda lo, hi: Window.partitionBy("scene_id", AXES[axis]).orderBy("_p").rowsBetween(lo, hi)
    rows = _folded(px, axis, reach)
    return rows.withColumns({n: f(frame) for n, f in out.items()}).where("_p = _i").drop("_i", "_n", "_p")


def shifted_sum(px: DataFrame, value: str, out: str, weights: Mapping[int, float], axis: str) -> DataFrame:
    """``out`` = sum of weight * value at each offset along ``axis``; beyond the border the mirror image, edge repeated.

    A null among the cells that count makes the sum null.
    """
    reach = max(abs(k) for k in weights)
    total = lambda frame: sum((F.first(value).over(frame(k, k)) * float(w) for k, w in weights.items()), F.lit(0.0))
    return _pass(px, axis, reach, {out: total})


def box_means(px: DataFrame, measures: Mapping[str, tuple[str, int]], axes: tuple[str, str] = ("x", "y")) -> DataFrame:
    """``px`` with ``{name: (column, k)}``: means over k x k cells, mirrored borders, nulls left out; null where all are.

    All measures share one pass along each axis. Passes along the same axis one after another share their shuffle.
    """
    reach = max(k // 2 for _, k in measures.values())
    span = lambda k: (-(k // 2), k - k // 2 - 1)
    first = {f"_s_{n}": (lambda w, c=c, k=k: F.sum(F.col(c).cast("double")).over(w(*span(k)))) for n, (c, k) in measures.items()}
    first |= {f"_c_{n}": (lambda w, c=c, k=k: F.count(c).over(w(*span(k)))) for n, (c, k) in measures.items()}
    then = {n: (lambda w, n=n, k=k: F.try_divide(F.sum(f"_s_{n}").over(w(*span(k))), F.sum(f"_c_{n}").over(w(*span(k))))) for n, (_, k) in measures.items()}
    return _pass(_pass(px, axes[0], reach, first), axes[1], reach, then).drop(*first)


def deviation(mean: str, mean_of_squares: str) -> Column:
    return F.sqrt(F.greatest(F.col(mean_of_squares) - F.col(mean) ** 2, F.lit(0.0)))


def focal_mean(px: DataFrame, value: str, k: int, out: str = "focal_mean") -> DataFrame:
    """Mean over k x k cells, mirrored borders; null cells are left out."""
    return box_means(px, {out: (value, k)})


def focal_std(px: DataFrame, value: str, k: int, out: str = "focal_std", axes: tuple[str, str] = ("x", "y")) -> DataFrame:
    """sqrt(max(E[v^2] - E[v]^2, 0)) over k x k cells; null cells are left out."""
    both = box_means(px.withColumn("_sq", F.col(value) * F.col(value)), {"_m": (value, k), "_m2": ("_sq", k)}, axes)
    return both.withColumn(out, deviation("_m", "_m2")).drop("_sq", "_m", "_m2")


def _extreme(px: DataFrame, value: str, k: int, out: str, f) -> DataFrame:
    lo, hi = -(k // 2), k - k // 2 - 1
    rows = px.withColumn("_row", f(value).over(line("x").rowsBetween(lo, hi)))
    return rows.withColumn(out, f("_row").over(line("y").rowsBetween(lo, hi))).drop("_row")


def focal_min(px: DataFrame, value: str, k: int, out: str = "focal_min") -> DataFrame:
    """Least value over k x k cells; a mirrored border adds no new values, so cells beyond it are left out."""
    return _extreme(px, value, k, out, F.min)


def focal_max(px: DataFrame, value: str, k: int, out: str = "focal_max") -> DataFrame:
    return _extreme(px, value, k, out, F.max)


def focal_range(px: DataFrame, value: str, k: int = 15, out: str = "focal_range", axes: tuple[str, str] = ("x", "y")) -> DataFrame:
    lo, hi = -(k // 2), k - k // 2 - 1
    ends = lambda a, low, high: (F.min(low).over(line(a).rowsBetween(lo, hi)), F.max(high).over(line(a).rowsBetween(lo, hi)))
    for a, low, high in ((axes[0], value, value), (axes[1], "_lo", "_hi")):
        least, most = ends(a, low, high)
        px = px.withColumns({"_lo": least, "_hi": most})
    return px.withColumn(out, F.col("_hi") - F.col("_lo")).drop("_lo", "_hi")


def relative_height(px: DataFrame, value: str, k: int, out: str = "relative_height") -> DataFrame:
    """Value minus focal mean; with k = 25 the topographic position index."""
    return focal_mean(px, value, k, "_m").withColumn(out, F.col(value) - F.col("_m")).drop("_m")


def slope(px: DataFrame, value: str, out: str = "slope") -> DataFrame:
    """Degrees of atan(hypot) of central differences, one-sided at the edges."""

    def gradient(axis: str) -> Column:
        w = line(axis)
        before, after, v = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
        return F.when(before.isNull() & after.isNull(), 0.0).when(before.isNull(), after - v).when(after.isNull(), v - before).otherwise((after - before) / 2.0)

    return px.withColumn("_gx", gradient("x")).withColumn("_gy", gradient("y")).withColumn(out, F.degrees(F.atan(F.hypot("_gx", "_gy")))).drop("_gx", "_gy")


def slope_roughness(px: DataFrame, value: str, k: int = 9, out: str = "slope_roughness") -> DataFrame:
    return focal_std(slope(px, value, "_slope"), "_slope", k, out, ("y", "x")).drop("_slope")


def texture_variance(px: DataFrame, value: str = "g", k: int = 7, out: str = "texture") -> DataFrame:
    return focal_std(px, value, k, "_sd").withColumn(out, F.col("_sd") ** 2).drop("_sd")


def cooccurrence(px: DataFrame, value: str = "g", window: int = 15, step: int = 15, levels: int = 16, top: float = 256) -> DataFrame:
    """``(scene_id, wy, wx, contrast, homogeneity)`` of right-neighbour grey pairs in windows that start every ``step`` cells.

    A pair and its reverse count alike, which leaves both measures as they are for the pair.
    """
    level = F.least(F.floor(F.col(value) * levels / top), F.lit(levels - 1))
    pairs = px.withColumn("_a", level).withColumn("_b", F.lead("_a").over(line("x"))).where("_b IS NOT NULL")
    starts = lambda c, size: F.sequence(F.greatest(F.ceil((F.col(c) - size + 1) / step), F.lit(0)), F.floor(F.col(c) / step))
    dealt = pairs.withColumn("wy", F.explode(starts("y", window))).withColumn("wx", F.explode(starts("x", window))).where((F.col("x") + 1 < F.col("wx") * step + window))
    d2 = (F.col("_a") - F.col("_b")) ** 2
    return dealt.groupBy("scene_id", "wy", "wx").agg(F.avg(d2).alias("contrast"), F.avg(1 / (1 + d2)).alias("homogeneity"))


def kernel(kind: str, size: int) -> list[tuple[int, int]]:
    """Offsets (dy, dx) of a square, circle, cross or diamond; an even size reaches one further up and left."""
    lo, hi = -(size // 2), size - size // 2 - 1
    r = size // 2
    inside = {
        "square": lambda dy, dx: True,
        "circle": lambda dy, dx: dy * dy + dx * dx <= r * r,
        "cross": lambda dy, dx: dy == 0 or dx == 0,
        "diamond": lambda dy, dx: abs(dy) + abs(dx) <= r,
    }[kind]
    return [(dy, dx) for dy in range(lo, hi + 1) for dx in range(lo, hi + 1) if inside(dy, dx)]


def _grow(px: DataFrame, mask: str, offsets: list[tuple[int, int]], least: bool) -> DataFrame:
    """Each cell's least or largest mask value over the offsets; cells outside the scene are left out."""
    size = max(max(abs(a), abs(b)) for a, b in offsets)
    square = set(offsets) == {(dy, dx) for dy, _ in offsets for _, dx in offsets}
    f = F.min if least else F.max
    if square and len(offsets) > 1:
        ys, xs = [a for a, _ in offsets], [b for _, b in offsets]
        rows = px.withColumn("_row", f(mask).over(line("x").rowsBetween(min(xs), max(xs))))
        return rows.withColumn(mask, f("_row").over(line("y").rowsBetween(min(ys), max(ys)))).drop("_row")
    if not size:
        return px
    # Only cells that decide are sent out: zeros when shrinking, ones when growing.
    decides = px.where(F.col(mask) == (0 if least else 1)).select("scene_id", "y", "x")
    moves = F.array(*(F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets))
    hit = decides.withColumn("_m", F.explode(moves)).select("scene_id", (F.col("y") - F.col("_m.dy")).alias("y"), (F.col("x") - F.col("_m.dx")).alias("x")).distinct().withColumn("_hit", F.lit(1))
    joined = px.join(hit, ["scene_id", "y", "x"], "left")
    return joined.withColumn(mask, F.when(F.col("_hit").isNotNull(), F.lit(0 if least else 1)).otherwise(F.col(mask))).drop("_hit")


def erode(px: DataFrame, mask: str = "mask", kind: str = "square", size: int = 3, times: int = 1) -> DataFrame:
    """A cell stays if all its kernel's cells inside the scene are set."""
    for _ in range(times):
        px = _grow(px, mask, kernel(kind, size), least=True)
    return px


def dilate(px: DataFrame, mask: str = "mask", kind: str = "square", size: int = 3, times: int = 1) -> DataFrame:
    mirrored = [(-dy, -dx) for dy, dx in kernel(kind, size)]
    for _ in range(times):
        px = _grow(px, mask, mirrored, least=False)
    return px


def open_mask(px: DataFrame, mask: str = "mask", kind: str = "square", size: int = 3) -> DataFrame:
    return dilate(erode(px, mask, kind, size), mask, kind, size)


def close_mask(px: DataFrame, mask: str = "mask", kind: str = "square", size: int = 3) -> DataFrame:
    return erode(dilate(px, mask, kind, size), mask, kind, size)


def guarded_open(px: DataFrame, mask: str = "mask", min_keep: float = 0.8, size: int = 3) -> DataFrame:
    """Opening, taken only by scenes that keep ``min_keep`` of their set cells."""
    both = open_mask(px.withColumn("_old", F.col(mask)), mask, "square", size)
    scene = Window.partitionBy("scene_id")
    kept = F.sum(mask).over(scene) >= min_keep * F.sum("_old").over(scene)
    return both.withColumn("_keep", kept).withColumn(mask, F.when(F.col("_keep"), F.col(mask)).otherwise(F.col("_old"))).drop("_old", "_keep")


def gentle_erode(px: DataFrame, n: int, mask: str = "mask") -> DataFrame:
    """n erosions by 3 x 3; an empty scene stays empty, so no stop is needed."""
    return erode(px, mask, "square", 3, n)


# Up to so many cells (None: any), the kernel's side, cells a pass, cells added first, passes added.
EROSION_STEPS = ((5, 3, 1, 0, 0), (15, 3, 2, 1, 0), (30, 5, 3, 0, 2), (None, 7, 5, 0, 3))


def erosion_steps(n: int, most: int = 50) -> tuple[int, int]:
    """The kernel's side and the passes, ``most`` at most, that shrink a mask by about ``n`` cells."""
    side, per, first, more = next(row[1:] for row in EROSION_STEPS if row[0] is None or n <= row[0])
    return side, min((n + first) // per + more, most)


def smart_erode(px: DataFrame, n: int, mask: str = "mask", kind: str = "square", least_share: float = 0.1, ref_compat: bool = False) -> DataFrame:
    """Erosion by about ``n`` cells in passes; a scene stops before the one that would leave less than ``least_share`` of its cells.

    ``ref_compat`` stops after one pass, as the tool it stands in for does.
    """
    size, times = erosion_steps(n)
    px = px.withColumn("_first", F.col(mask))
    scene = Window.partitionBy("scene_id")
    for _ in range(min(times, 1) if ref_compat else times):
        both = erode(px.withColumn("_old", F.col(mask)), mask, kind, size)
        fine = F.sum(mask).over(scene) >= F.floor(least_share * F.sum("_first").over(scene))
        px = both.withColumn("_ok", fine).withColumn(mask, F.when(F.col("_ok"), F.col(mask)).otherwise(F.col("_old"))).drop("_old", "_ok")
    return px.drop("_first")


def focal_median(px: DataFrame, mask: str = "mask") -> DataFrame:
    """Majority of a cell and its four neighbours; beyond the border the mirror image, the cell itself."""
    near = lambda axis, f: F.coalesce(f(mask).over(line(axis)), F.col(mask))
    total = px.withColumn("_h", near("x", F.lag) + near("x", F.lead)).withColumn("_v", near("y", F.lag) + near("y", F.lead))
    return total.withColumn(mask, (F.col(mask) + F.col("_h") + F.col("_v") >= 3).cast("int")).drop("_h", "_v")


def gaussian_smooth(px: DataFrame, mask: str = "mask", sigma: float = 0.8, thr: float = 0.5) -> DataFrame:
    """Gaussian sums of radius int(4 sigma + 0.5), cut at ``thr``."""
    from math import exp

    r = int(4 * sigma + 0.5)
    raw = {k: exp(-(k * k) / (2 * sigma * sigma)) for k in range(-r, r + 1)}
    weights = {k: v / sum(raw.values()) for k, v in raw.items()}
    done = shifted_sum(shifted_sum(px, mask, "_a", weights, "x"), "_a", "_b", weights, "y")
    return done.withColumn(mask, (F.col("_b") > thr).cast("int")).drop("_a", "_b")
