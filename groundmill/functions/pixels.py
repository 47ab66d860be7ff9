"""Column functions over pixels and polygons' numbers: masks, classes, units, affine maps and map projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SQUARE_METRES_PER_ACRE = 4046.8564224


def binarize(px: DataFrame, band: str, mode: str = "auto", value: float = 1, by: str = "scene_id") -> DataFrame:
    """``px`` with ``mask`` 0 or 1.

    "auto" looks at a scene's values: {0, 1} stay, of two values the larger is 1, values within [0, 1] cut at 0.5, else
    the largest value is 1. "positive": above 0, null as 0. "equals": equal to ``value``.
    """
    if mode == "positive":
        return px.withColumn("mask", (F.coalesce(F.col(band), F.lit(0)) > 0).cast("int"))
    if mode == "equals":
        return px.withColumn("mask", F.coalesce(F.col(band) == value, F.lit(False)).cast("int"))
    stats = px.groupBy(by).agg(F.min(band).alias("_lo"), F.max(band).alias("_hi"), F.count_distinct(band).alias("_n"))
    unit = (F.col("_lo") >= 0) & (F.col("_hi") <= 1)
    rule = F.when((F.col("_n") > 2) & unit, F.col(band) > 0.5).otherwise((F.col(band) == F.col("_hi")) & ~((F.col("_n") == 1) & (F.col("_hi") == 0)))
    return px.join(stats, by).withColumn("mask", F.coalesce(rule, F.lit(False)).cast("int")).drop("_lo", "_hi", "_n")


def paste_class(cls: Column, mask: Column, value: int) -> Column:
    """Class raster with the old pixels of a class cleared and its cleaned mask written."""
    return F.when(mask == 1, value).when(cls == value, 0).otherwise(cls)


def threshold_probability(thresholds: Mapping[str, float]) -> dict[str, Column]:
    """0/1 columns ``m_<model>`` for ``p_<model>`` strictly above its threshold."""
    return {f"m_{m}": F.coalesce(F.col(f"p_{m}") > t, F.lit(False)).cast("int") for m, t in thresholds.items()}


def excess_green(px: DataFrame, thr: float = 0.1, by: str = "scene_id") -> DataFrame:
    """``px`` with ``veg``: 2g - r - b above ``thr``, bands divided by 255 where a scene exceeds 1."""
    top = px.groupBy(by).agg(F.max(F.greatest("r", "g", "b")).alias("_top"))
    unit = F.when(F.col("_top") > 1, 255.0).otherwise(1.0)
    veg = (F.lit(2) * F.col("g") / unit - F.col("r") / unit - F.col("b") / unit) > thr
    return px.join(top, by).withColumn("veg", F.coalesce(veg, F.lit(False)).cast("int")).drop("_top")


def pixel_to_world(col: Column, row: Column, t: Column) -> Column:
    """Affine map of a pixel's corner; ``t`` is struct<a,b,c,d,e,f>."""
    return F.struct((t["a"] * col + t["b"] * row + t["c"]).alias("x"), (t["d"] * col + t["e"] * row + t["f"]).alias("y"))


def world_to_pixel(x: Column, y: Column, t: Column) -> Column:
    det = t["a"] * t["e"] - t["b"] * t["d"]
    dx, dy = x - t["c"], y - t["f"]
    return F.struct(((t["e"] * dx - t["b"] * dy) / det).alias("col"), ((t["a"] * dy - t["d"] * dx) / det).alias("row"))


def shift(ring: Column, dx: float, dy: float) -> Column:
    return F.transform(ring, lambda p: F.struct((p["x"] + dx).alias("x"), (p["y"] + dy).alias("y")))


def window_transform(t: Column, row_off: Column, col_off: Column, zoom: Column | float = 1) -> Column:
    """The affine map of a window: origin moved to it, pixel size divided by ``zoom``."""
    z = F.lit(zoom) if not isinstance(zoom, Column) else zoom
    at = pixel_to_world(col_off, row_off, t)
    return F.struct((t["a"] / z).alias("a"), (t["b"] / z).alias("b"), at["x"].alias("c"), (t["d"] / z).alias("d"), (t["e"] / z).alias("e"), at["y"].alias("f"))


def to_utm(lon: Column, lat: Column, zone: int) -> Column:
    """WGS84 degrees to UTM north (EPSG 326xx) by the transverse Mercator series."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = F.radians(lat), F.radians(lon) - F.radians(F.lit(float(zone * 6 - 183)))
    n = F.lit(a) / F.sqrt(1 - e2 * F.sin(phi) ** 2)
    t, c, x = F.tan(phi) ** 2, ep2 * F.cos(phi) ** 2, F.cos(phi) * lam
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * phi)
             + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * phi) - (35 * e2**3 / 3072) * F.sin(6 * phi))
    east = k0 * n * (x + (1 - t + c) * x**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * x**5 / 120) + 500000.0
    north = k0 * (m + n * F.tan(phi) * (x**2 / 2 + (5 - t + 9 * c + 4 * c**2) * x**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * x**6 / 720))
    return F.struct(east.alias("x"), north.alias("y"))


def from_utm(x: Column, y: Column, zone: int) -> Column:
    """UTM north to WGS84 degrees."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2, e1 = e2 / (1 - e2), (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    mu = (y / k0) / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + (151 * e1**3 / 96) * F.sin(6 * mu)
    s = 1 - e2 * F.sin(p) ** 2
    n, r = F.lit(a) / F.sqrt(s), a * (1 - e2) / (s * F.sqrt(s))
    t, c, d = F.tan(p) ** 2, ep2 * F.cos(p) ** 2, (x - 500000.0) / (n * k0)
    lat = p - (n * F.tan(p) / r) * (d**2 / 2 - (5 + 3 * t + 10 * c - 4 * c**2 - 9 * ep2) * d**4 / 24 + (61 + 90 * t + 298 * c + 45 * t**2 - 252 * ep2 - 3 * c**2) * d**6 / 720)
    lon = (d - (1 + 2 * t + c) * d**3 / 6 + (5 - 2 * c + 28 * t - 3 * c**2 + 8 * ep2 + 24 * t**2) * d**5 / 120) / F.cos(p)
    return F.struct((F.degrees(lon) + float(zone * 6 - 183)).alias("x"), F.degrees(lat).alias("y"))


def reproject_ring(ring: Column, source: int, target: int) -> Column:
    """A ring between EPSG 4326 and 326xx; null ``source`` counts as ``target``; other systems raise ``ValueError``."""
    if source is None or source == target:
        return ring
    if source == 4326 and 32601 <= target <= 32660:
        return F.transform(ring, lambda p: to_utm(p["x"], p["y"], target - 32600))
    if target == 4326 and 32601 <= source <= 32660:
        return F.transform(ring, lambda p: from_utm(p["x"], p["y"], source - 32600))
    if 32601 <= source <= 32660 and 32601 <= target <= 32660:
        return reproject_ring(reproject_ring(ring, source, 4326), 4326, target)
    raise ValueError(f"no map from EPSG {source} to {target}")


def to_acres(area_m2: Column, per_acre: float = SQUARE_METRES_PER_ACRE) -> Column:
    return area_m2 / per_acre


def to_hectares(area_m2: Column) -> Column:
    return area_m2 / 10000.0


def degree_area_to_m2(area: Column) -> Column:
    """Area in square degrees, one degree taken as 111 km."""
    return area * (111000.0**2)


def size_class(area_ha: Column) -> Column:
    return F.when(area_ha < 0.5, "small").when(area_ha < 2, "medium").when(area_ha.isNotNull(), "large")


def row_uuid(keys: Sequence[str] | None = None) -> Column:
    """An id per row: random, or a digest of ``keys`` that reruns repeat."""
    return F.expr("uuid()") if keys is None else F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys)), 256)


def exclude_category(df: DataFrame, col: str, value: str) -> DataFrame:
    """Rows whose category is not ``value``; null categories stay."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def to_8bit(px: DataFrame, band: str, uint16: bool, by: str = "scene_id") -> DataFrame:
    """``<band>_8``: 16-bit values times 255 / 65535, others stretched from the scene's least to largest."""
    if uint16:
        return px.withColumn(f"{band}_8", F.floor(F.col(band) * 255 / 65535).cast("int"))
    ends = px.groupBy(by).agg(F.min(band).alias("_lo"), F.max(band).alias("_hi"))
    return px.join(ends, by).withColumn(f"{band}_8", F.floor((F.col(band) - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1e-8) * 255).cast("int")).drop("_lo", "_hi")


def one_hot_class(cls: Column, n: int) -> list[Column]:
    return [(cls == i).cast("int").alias(f"is_{i}") for i in range(n)]


def zoom_factor(t: Column, target: float) -> Column:
    """Least of the pixel sides over the wanted resolution."""
    return F.least(F.abs(t["a"]), F.abs(t["e"])) / target


def bbox_overlaps(a: Column, b: Column) -> Column:
    """Boxes struct<x0,y0,x1,y1> that are not strictly apart."""
    return (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


def iou_rating(iou: Column) -> Column:
    return F.when(iou > 0.8, "excellent").when(iou > 0.7, "good").when(iou > 0.5, "moderate").otherwise("low")
