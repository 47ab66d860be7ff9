"""Green-cover classes: texture and height proxies of vegetation, and the trees-or-crops score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.functions.pixels import excess_green
from groundmill.operators import focal
from groundmill.plans.graph import stored

METRICS = ("std9", "std15", "std25", "rel15", "rel51", "range15", "tpi25", "slope_rough")


def veg_metrics(px: DataFrame, height: str = "dem") -> DataFrame:
    """``px`` with the local measures of a height or brightness column, stored: percentiles and pixels both read them."""
    v, rows = F.col(height), px.count()
    means = {f"_m{k}": (height, k) for k in (9, 15, 25, 51)} | {f"_q{k}": ("_sq", k) for k in (9, 15, 25)}
    px = focal.box_means(px.withColumn("_sq", v * v), means)
    px = px.withColumns({f"std{k}": focal.deviation(f"_m{k}", f"_q{k}") for k in (9, 15, 25)} | {"rel15": v - F.col("_m15"), "rel51": v - F.col("_m51"), "tpi25": v - F.col("_m25")}).drop("_sq", *means)
    return stored(focal.slope_roughness(focal.focal_range(px, height, 15, "range15", ("y", "x")), height, 9, "slope_rough"), rows)


def veg_normalize(px: DataFrame, cols: Sequence[str], veg: str = "veg", scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``<col>_v``: (v - p1) / (p99 - p1) within [0, 1], percentiles over vegetation; 0 off it or where it is flat."""
    on = F.col(veg) == 1
    both = px.groupBy(*scope).agg(*(F.percentile(F.when(on, F.col(c)), [0.01, 0.99]).alias(f"_{c}") for c in cols))
    ends = both.select(*scope, *(F.get(f"_{c}", F.lit(i)).alias(f"_{c}{q}") for c in cols for i, q in enumerate((1, 99))))
    value = lambda c: F.coalesce(F.try_divide(F.col(c) - F.col(f"_{c}1"), F.col(f"_{c}99") - F.col(f"_{c}1")), F.lit(0.0))
    out = {f"{c}_v": F.when(on, F.least(F.greatest(value(c), F.lit(0.0)), F.lit(1.0))).otherwise(0.0) for c in cols}
    return px.join(ends, list(scope)).withColumns(out).drop(*(f"_{c}{q}" for c in cols for q in (1, 99)))


def height_proxy(px: DataFrame, method: str = "combined", scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``proxy``: weighted normalised measures, or one measure alone."""
    if method != "combined":
        return veg_normalize(px, [method], scope=scope).withColumnRenamed(f"{method}_v", "proxy")
    weights = {"range15": 0.30, "std15": 0.25, "abs_rel15": 0.20, "std25": 0.15, "slope_rough": 0.10}
    scaled = veg_normalize(px.withColumn("abs_rel15", F.abs("rel15")), list(weights), scope=scope)
    return scaled.withColumn("proxy", sum((F.col(f"{c}_v") * w for c, w in weights.items()), F.lit(0.0))).drop("abs_rel15", *(f"{c}_v" for c in weights))


def height_class(px: DataFrame, proxy: str = "proxy", veg: str = "veg", scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """``height_class``: 0 off vegetation, else 1 to 3 by the vegetation's 33rd and 66th percentile."""
    on = F.col(veg) == 1
    cuts = px.groupBy(*scope).agg(F.percentile(F.when(on, F.col(proxy)), F.lit(0.33)).alias("_p33"), F.percentile(F.when(on, F.col(proxy)), F.lit(0.66)).alias("_p66"))
    level = F.when(~on | F.col(proxy).isNull(), 0).when(F.col(proxy) > F.col("_p66"), 3).when(F.col(proxy) > F.col("_p33"), 2).otherwise(1)
    return px.join(cuts, list(scope)).withColumn("height_class", level).drop("_p33", "_p66")


def green_cover(px: DataFrame, height: str = "dem", method: str = "combined", scope: Sequence[str] = ("scene_id",)) -> DataFrame:
    """Vegetation by excess green, its height proxy and class; ``scope`` adds tile keys for tile-wise percentiles."""
    return height_class(height_proxy(veg_metrics(excess_green(px), height), method, scope), scope=scope)


def tree_vs_crop(px: DataFrame, veg: str = "veg") -> DataFrame:
    """``tree``: .30 texture + .25 irregularity + .25 deviation + .20 slope on vegetation, above 0.5.

    Texture, deviation and slope are those of ``g``, normalised over vegetation; ``irregularity`` counts as it is
    (``regions.with_irregularity``).
    """
    px = stored(px)
    measured = stored(focal.slope(focal.focal_std(focal.texture_variance(px), "g", 15, "_sd"), "g", "_sl"), px.count())
    weights = {"texture": 0.30, "_sd": 0.25, "_sl": 0.20}
    scaled = veg_normalize(measured, list(weights), veg)
    score = F.when(F.col(veg) == 1, sum((F.col(f"{c}_v") * w for c, w in weights.items()), 0.25 * F.col("irregularity"))).otherwise(0.0)
    return scaled.withColumn("tree_score", score).withColumn("tree", (score > 0.5).cast("int")).drop("_sd", "_sl", *(f"{c}_v" for c in weights))
