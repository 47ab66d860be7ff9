"""Band normalisation: per-scene statistics, joined back to the pixels.

Statistics are one row a scene, so Spark broadcasts them while they are small and shuffles them beyond; pixels are
read once for the statistics (with map-side sums where the statistic allows) and once for the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.operators.focal import line


def _with_stats(px: DataFrame, scope: Sequence[str], aggs: dict[str, Column], out: dict[str, Column]) -> DataFrame:
    stats = px.groupBy(*scope).agg(*(c.alias(n) for n, c in aggs.items()))
    return px.join(stats, list(scope)).withColumns(out).drop(*aggs)


def percentile_stretch(px: DataFrame, bands: Sequence[str], lo: float = 2.5, hi: float = 99, scope: Sequence[str] = ("scene_id",),
                       round_ends: bool = True, zero_to_one: bool = True, keep_nodata: bool = False, exact: bool = True) -> DataFrame:
    """``<band>_s``: floor(255 * (clipped - t1) / (t2 - t1)), t1 and t2 percentiles of the values above 0, rounded half-even.

    A band whose ends meet becomes 0; 0 becomes 1 if ``zero_to_one``; with ``keep_nodata`` pixels not above 0 stay 0.
    ``exact=False`` takes approximate percentiles, for float bands of many values.
    """
    aggs, out = {}, {}
    for b in bands:
        positive = F.when(F.col(b) > 0, F.col(b))
        for n, p in (("_1", lo), ("_2", hi)):
            end = F.percentile(positive, F.lit(p / 100)) if exact else F.approx_percentile(positive.cast("double"), p / 100, 100_000)
            aggs[b + n] = F.bround(end, 0) if round_ends else end
        t1, t2 = F.col(b + "_1"), F.col(b + "_2")
        s = F.when(t2 > t1, F.floor(255 * (F.least(F.greatest(F.col(b), t1), t2) - t1) / (t2 - t1))).otherwise(F.lit(0)).cast("int")
        s = F.when(s == 0, 1).otherwise(s) if zero_to_one else s
        out[b + "_s"] = F.when(F.col(b) > 0, s).otherwise(0) if keep_nodata else s
    return _with_stats(px, scope, aggs, out)


def histogram_stretch(px: DataFrame, band: str, lo: float = 2.5, hi: float = 99, bins: int = 1024, scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """As ``percentile_stretch``, its ends the first bins at which the counts reach the share; ranges are fixed first."""
    scope = list(scope)
    positive = px.where(F.col(band) > 0)
    ends = positive.groupBy(*scope).agg(F.min(band).cast("double").alias("_lo"), F.max(band).cast("double").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / bins
    bin_of = F.when(step > 0, F.least(F.floor((F.col(band) - F.col("_lo")) / step), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = positive.join(ends, scope).groupBy(*scope, "_lo", "_hi", bin_of.alias("bin")).count()
    up = Window.partitionBy(*scope).orderBy("bin")
    cdf = counts.withColumn("cum", F.sum("count").over(up)).withColumn("all", F.sum("count").over(Window.partitionBy(*scope)))
    edge = F.col("_lo") + F.col("bin") * step
    marks = cdf.groupBy(*scope).agg(*(F.min(F.when(F.col("cum") >= F.col("all") * (q / 100), edge)).alias(n) for n, q in (("t1", lo), ("t2", hi))))
    s = F.when(F.col("t2") > F.col("t1"), F.floor(255 * (F.least(F.greatest(F.col(band), "t1"), "t2") - F.col("t1")) / (F.col("t2") - F.col("t1")))).otherwise(0)
    return px.join(marks, scope, "left").withColumn(f"{band}_s", F.coalesce(s, F.lit(0)).cast("int")).drop("t1", "t2")


def sampled_stretch(px: DataFrame, band: str, block: Sequence[str], per_block: int = 500, lo: float = 2.5, hi: float = 99, seed: int = 42, scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``percentile_stretch`` with ends from at most ``per_block`` values above 0 of each block, drawn by hash."""
    draw = F.row_number().over(Window.partitionBy(*scope, *block).orderBy(F.xxhash64(*scope, "y", "x", F.lit(seed)), "y", "x"))
    pool = px.where(F.col(band) > 0).withColumn("_n", draw).where(F.col("_n") <= per_block)
    ends = pool.groupBy(*scope).agg(F.percentile(band, F.lit(lo / 100)).alias("t1"), F.percentile(band, F.lit(hi / 100)).alias("t2"))
    s = F.when(F.col("t2") > F.col("t1"), F.floor(255 * (F.least(F.greatest(F.col(band), "t1"), "t2") - F.col("t1")) / (F.col("t2") - F.col("t1")))).otherwise(0)
    return px.join(ends, list(scope), "left").withColumn(f"{band}_s", F.coalesce(s, F.lit(0)).cast("int")).drop("t1", "t2")


def min_max(px: DataFrame, bands: Sequence[str], scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``<band>_n``: (v - min) / (max - min); a constant band is 0."""
    aggs = {f"{b}_{n}": f(b) for b in bands for n, f in (("lo", F.min), ("hi", F.max))}
    out = {f"{b}_n": F.coalesce(F.try_divide(F.col(b) - F.col(f"{b}_lo"), F.col(f"{b}_hi") - F.col(f"{b}_lo")), F.lit(0.0)) for b in bands}
    return _with_stats(px, scope, aggs, out)


def clip01_percentile(px: DataFrame, band: str, lo: float = 2, hi: float = 98, scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``<band>_c``: (v - p_lo) / (p_hi - p_lo) within [0, 1], percentiles over the whole band."""
    aggs = {"_p1": F.percentile(band, F.lit(lo / 100)), "_p2": F.percentile(band, F.lit(hi / 100))}
    v = F.try_divide(F.col(band) - F.col("_p1"), F.col("_p2") - F.col("_p1"))
    return _with_stats(px, scope, aggs, {f"{band}_c": F.coalesce(F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))})


def grey(bands: Sequence[str] = ("r", "g", "b")) -> Column:
    return sum((F.col(b) for b in bands[1:]), F.col(bands[0])) / float(len(bands))


def sigma_clip(px: DataFrame, k: float = 2, scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``grey_k``: the mean of the bands, clipped to mean +- k population deviations of its nonzero values, as 0 to 1."""
    some = F.when(grey() != 0, grey())
    aggs = {"_m": F.avg(some), "_s": F.stddev_pop(some)}
    low, high = F.col("_m") - k * F.col("_s"), F.col("_m") + k * F.col("_s")
    return _with_stats(px, scope, aggs, {"grey_k": F.coalesce(F.try_divide(F.least(F.greatest(grey(), low), high) - low, high - low), F.lit(0.0))})


def adaptive_equalize(px: DataFrame, band: str, height: int, width: int, grid: int = 8, clip: float = 0.01, bins: int = 256) -> DataFrame:
    """``<band>_e``: histogram equalisation in ``grid`` x ``grid`` regions, counts clipped, blended between regions.

    ``band`` is within [0, 1]. A bin keeps at most clip * region size; the excess is spread over all bins. A pixel takes
    the bilinear mean of the four nearest regions' distribution at its bin. Close to, not equal with, image libraries.
    """
    rh, rw = height / grid, width / grid
    with_bin = px.withColumn("_bin", F.least(F.floor(F.col(band) * bins), F.lit(bins - 1)).cast("int"))
    region = [F.least(F.floor(F.col("y") / rh), F.lit(grid - 1)).cast("int").alias("gy"), F.least(F.floor(F.col("x") / rw), F.lit(grid - 1)).cast("int").alias("gx")]
    counts = with_bin.select("scene_id", *region, "_bin").groupBy("scene_id", "gy", "gx", "_bin").count()
    whole = counts.groupBy("scene_id", "gy", "gx").agg(F.sum("count").alias("n"))
    dense = whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_bin")).join(counts, ["scene_id", "gy", "gx", "_bin"], "left").fillna(0, ["count"])
    each = Window.partitionBy("scene_id", "gy", "gx")
    top = F.greatest(F.lit(1.0), clip * F.col("n"))
    cut = dense.withColumn("_c", F.least(F.col("count"), top)).withColumn("_c", F.col("_c") + (F.col("n") - F.sum("_c").over(each)) / bins)
    table = cut.withColumn("cdf", F.sum("_c").over(each.orderBy("_bin")) / F.col("n")).select("scene_id", "gy", "gx", "_bin", "cdf")
    fy, fx = (F.col("y") + 0.5) / rh - 0.5, (F.col("x") + 0.5) / rw - 0.5
    placed = with_bin.withColumn("_fy", fy).withColumn("_fx", fx).withColumn("_d", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))))
    wy, wx = F.col("_fy") - F.floor("_fy"), F.col("_fx") - F.floor("_fx")
    weight = F.when(F.col("_d.i") == 1, wy).otherwise(1 - wy) * F.when(F.col("_d.j") == 1, wx).otherwise(1 - wx)
    clamp = lambda c: F.least(F.greatest(c, F.lit(0)), F.lit(grid - 1)).cast("int")
    near = placed.withColumn("_w", weight).withColumn("gy", clamp(F.floor("_fy") + F.col("_d.i"))).withColumn("gx", clamp(F.floor("_fx") + F.col("_d.j")))
    value = near.join(table, ["scene_id", "gy", "gx", "_bin"]).groupBy("scene_id", "y", "x").agg(F.sum(F.col("_w") * F.col("cdf")).alias(f"{band}_e"))
    return px.join(value, ["scene_id", "y", "x"])


def sobel(px: DataFrame, value: Column | None = None, height: int | None = None, width: int | None = None) -> DataFrame:
    """``edge``: hypot of the 3x3 Sobel sums of ``value`` (grey by default), borders mirrored with the edge repeated.

    One pass along each axis: each takes differences and smooth sums of the neighbours at once. A null among the nine cells makes the edge null.
    """
    v = grey() if value is None else value

    def ends(axis: str, name: str) -> tuple[Column, Column]:
        # A missing neighbour is the border, whose mirror image is the cell itself; a null one stays null.
        cell = F.struct(F.col(name).alias("v"))
        near = lambda f: F.coalesce(f(cell).over(line(axis)), cell)["v"]
        return near(F.lag), near(F.lead)

    def smooth(axis: str, name: str) -> Column:
        before, after = ends(axis, name)
        return 0.25 * before + 0.5 * F.col(name) + 0.25 * after

    def diff(axis: str, name: str) -> Column:
        before, after = ends(axis, name)
        return after - before

    first = px.withColumn("_v", v).withColumns({"_dx": diff("x", "_v"), "_sx": smooth("x", "_v")})
    both = first.withColumns({"_gx": smooth("y", "_dx"), "_gy": diff("y", "_sx")})
    return both.withColumn("edge", F.sqrt((F.col("_gx") ** 2 + F.col("_gy") ** 2) / 2)).drop("_v", "_dx", "_sx", "_gx", "_gy")


def sobel_normalised(px: DataFrame, norm: str = "min_max", scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``sobel`` with ``edge_n``: "sigma" ((v - min) / deviation where grey > 0), "min_max", "percentile" (2.5 to 97.5 of values above 0), "sigma_percentile" ("sigma", then 2.5 to 99)."""
    if norm == "sigma_percentile":
        scaled = sobel_normalised(px, "sigma", scope)
        aggs = {"_p1": F.percentile("edge_n", F.lit(0.025)), "_p2": F.percentile("edge_n", F.lit(0.99))}
        v = F.try_divide(F.least(F.greatest(F.col("edge_n"), "_p1"), "_p2") - F.col("_p1"), F.col("_p2") - F.col("_p1"))
        return _with_stats(scaled, scope, aggs, {"edge_n": F.coalesce(v, F.lit(0.0))})
    return sobel_norms(px, {"edge_n": norm}, scope)


def sobel_norms(px: DataFrame, norms: Mapping[str, str], scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``sobel`` with a column for each name in ``norms``, of one of the norms "sigma", "percentile" and "min_max"; all share the edges and one pass for statistics."""
    edge, some = F.col("edge"), F.when(F.col("edge") > 0, F.col("edge"))
    aggs = {
        "min_max": {"_lo": F.min("edge"), "_hi": F.max("edge")}, "sigma": {"_lo": F.min("edge"), "_sd": F.stddev_pop("edge")},
        "percentile": {"_p1": F.percentile(some, F.lit(0.025)), "_p2": F.percentile(some, F.lit(0.975))},
    }
    top = F.when(F.col("_p1") == F.col("_p2"), F.col("_p1") + 1e-5).otherwise(F.col("_p2"))
    out = {
        "min_max": F.coalesce(F.try_divide(edge - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)),
        "sigma": F.when(grey() > 0, F.coalesce(F.try_divide(edge - F.col("_lo"), F.col("_sd")), F.lit(0.0))).otherwise(0.0),
        "percentile": F.coalesce((F.least(F.greatest(edge, F.col("_p1")), top) - F.col("_p1")) / (top - F.col("_p1")), F.lit(0.0)),
    }
    needed = {n: a for norm in norms.values() for n, a in aggs[norm].items()}
    return _with_stats(sobel(px), scope, needed, {name: out[norm] for name, norm in norms.items()})


def positive_percentiles(px: DataFrame, cols: Sequence[str], scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``<col>_n``: from 0 at the 2.5th to 1 at the 97.5th percentile of the column's values above 0; 0 where there are none."""
    aggs, out = {}, {}
    for c in cols:
        some = F.when(F.col(c) > 0, F.col(c))
        aggs |= {f"_{c}1": F.percentile(some, F.lit(0.025)), f"_{c}2": F.percentile(some, F.lit(0.975))}
        low = F.col(f"_{c}1")
        high = F.when(low == F.col(f"_{c}2"), low + 1e-5).otherwise(F.col(f"_{c}2"))
        out[f"{c}_n"] = F.coalesce((F.least(F.greatest(F.col(c), low), high) - low) / (high - low), F.lit(0.0))
    return _with_stats(px, scope, aggs, out)


def waterbody_edges(px: DataFrame, scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``stack``: two bands and the edge magnitude, each from 0 to 1."""
    return min_max(sobel(px), ["r", "g", "edge"], scope).withColumn("stack", stack_channels(["r_n", "g_n", "edge_n"]))


def waterbody_stack(px: DataFrame, nir: str = "nir", scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``stack`` of five bands: red, green, blue from 0 to 1, near infrared and the edges of their grey by percentiles above 0."""
    bands = min_max(px, ["r", "g", "b"], scope)
    edges = sobel(bands, (F.col("r_n") + F.col("g_n") + F.col("b_n")) / 3)
    return positive_percentiles(edges, [nir, "edge"], scope).withColumn("stack", stack_channels(["r_n", "g_n", "b_n", f"{nir}_n", "edge_n"]))


def stack_channels(order: Sequence[str]) -> Column:
    return F.array(*(F.col(c).cast("double") for c in order))


def fixed_stat_scale(px: DataFrame, bands: Sequence[str] = ("r", "g", "b"), edge: str = "edge", mean: float = 0.89, sd: float = 0.97, by: str = "scene_id") -> DataFrame:
    """Bands divided by 255 where the scene exceeds 1; the edge band clipped to [0, mean + 3 sd] and divided by that."""
    top = mean + 3 * sd
    out = {f"{b}_f": F.col(b) / F.when(F.col("_top") > 1, 255.0).otherwise(1.0) for b in bands}
    out[f"{edge}_f"] = F.least(F.greatest(F.col(edge), F.lit(0.0)), F.lit(top)) / top
    return _with_stats(px, (by,), {"_top": F.max(F.greatest(*bands))}, out)


def scale_255(bands: Sequence[str]) -> dict[str, Column]:
    return {f"{b}_u": F.col(b) / 255.0 for b in bands}
