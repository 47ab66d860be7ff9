"""Scoring tiles with a user's model, test-time variants, blending, class resolution."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_tiles(tiles: DataFrame, model: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str, batch_size: int = 16) -> DataFrame:
    """The model over batches of at most ``batch_size`` tiles; it gets an iterator, so it loads once a task. Rows keep their keys, so none can shift."""

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return model(f.iloc[k : k + batch_size] for f in frames for k in range(0, len(f), batch_size))

    return tiles.mapInPandas(score, schema)


def linear_model(bands: Mapping[str, float], bias: float) -> Column:
    """A logistic of weighted bands, as a column."""
    z = F.lit(float(bias))
    for b, w in bands.items():
        z = z + F.col(b) * w
    return 1 / (1 + F.exp(-z))


#: (name, quarter turns, flip): a variant flips left-right or transposes first, then turns; 7 and 9 repeat the flips.
VARIANTS = (("id", 0, ""), ("lr", 0, "lr"), ("ud", 0, "ud"), ("r1", 1, ""), ("r2", 2, ""), ("r3", 3, ""), ("t", 0, "t"), ("t1", 1, "t"), ("t2", 2, "t"), ("t3", 3, "t"))
FOUR = (("id", 0, ""), ("lr", 0, "lr"), ("ud", 0, "ud"), ("both", 2, ""))


def _move(y: Column, x: Column, size: int, turns: int, flip: str) -> tuple[Column, Column]:
    """Where the cell (y, x) goes: the flip, then quarter turns against the clock."""
    last = size - 1
    y, x = {"": (y, x), "lr": (y, last - x), "ud": (last - y, x), "t": (x, y)}[flip]
    for _ in range(turns):
        y, x = last - x, y
    return y, x


def _back(y: Column, x: Column, size: int, turns: int, flip: str) -> tuple[Column, Column]:
    for _ in range(turns):
        y, x = x, size - 1 - y
    return {"": (y, x), "lr": (y, size - 1 - x), "ud": (size - 1 - y, x), "t": (x, y)}[flip]


def _by_variant(f, size: int, variants) -> tuple[Column, Column]:
    y = x = None
    for name, turns, flip in variants:
        a, b = f(F.col("ty"), F.col("tx"), size, turns, flip)
        hit = F.col("variant") == name
        y, x = (F.when(hit, a), F.when(hit, b)) if y is None else (y.when(hit, a), x.when(hit, b))
    return y, x


def tta_expand(cells: DataFrame, size: int, variants: int = 10) -> DataFrame:
    """Tile cells in each variant: columns ``variant`` and moved ``ty, tx``."""
    chosen = VARIANTS if variants == 10 else FOUR
    many = cells.withColumn("variant", F.explode(F.array(*(F.lit(n) for n, _, _ in chosen))))
    y, x = _by_variant(_move, size, chosen)
    return many.withColumns({"ty": y, "tx": x})


def tta_merge(preds: DataFrame, size: int, value: str, keys: Sequence[str] = ("scene_id", "grid_i", "grid_j"), variants: int = 10) -> DataFrame:
    """The mean over variants, each undone by its inverse."""
    y, x = _by_variant(_back, size, VARIANTS if variants == 10 else FOUR)
    return preds.withColumns({"ty": y, "tx": x}).groupBy(*keys, "ty", "tx").agg(F.avg(value).alias(value))


def blend_tiles(preds: DataFrame, size: int, overlap: int, value: str, ramp: str = "open", win_h: Column | None = None, win_w: Column | None = None) -> DataFrame:
    """``(scene_id, y, x, <value>)``: sum of weight * value over sum of weight, 0 where no weight falls.

    The weight is the product of ramps towards the four sides over ``overlap`` cells: i / overlap ("zero", 0 at the
    edge) or (i + 1) / (overlap + 1) ("open").
    """
    h, w = win_h if win_h is not None else F.lit(size), win_w if win_w is not None else F.lit(size)
    rise = (lambda i: i / float(overlap)) if ramp == "zero" else (lambda i: (i + 1) / float(overlap + 1))
    side = lambda p, n: F.least(F.lit(1.0), rise(p)) * F.least(F.lit(1.0), rise(n - 1 - p))
    weight = side(F.col("ty"), h) * side(F.col("tx"), w) if overlap else F.lit(1.0)
    sums = preds.withColumn("_w", weight).groupBy("scene_id", "y", "x").agg(F.sum(F.col("_w") * F.col(value)).alias("_s"), F.sum("_w").alias("_n"))
    return sums.select("scene_id", "y", "x", F.coalesce(F.try_divide("_s", "_n"), F.lit(0.0)).alias(value))


def resolve_classes(thresholds: Mapping[str, float], margin: float = 0.1, priority: Sequence[int] = (1, 2, 3), mode: str = "margin") -> Column:
    """The class of a pixel from ``p_<model>`` columns; classes are numbered from 1 in the order of ``thresholds``.

    "margin": none above its threshold is 0, one is it, of several the most probable if it leads by more than
    ``margin``, else the first in ``priority``. "first": the first in ``priority`` above its threshold. "single": the
    first model only. "last_wins": a later model overwrites.
    """
    names = list(thresholds)
    if sorted(priority) != list(range(1, len(names) + 1)):
        raise ValueError("the priority must list every class once")
    above = {k + 1: F.coalesce(F.col(f"p_{m}") > thresholds[m], F.lit(False)) for k, m in enumerate(names)}
    if mode == "single":
        return F.when(above[1], 1).otherwise(0)
    if mode == "last_wins":
        return F.coalesce(*(F.when(above[k], k) for k in sorted(above, reverse=True)), F.lit(0))
    first = F.coalesce(*(F.when(above[k], k) for k in priority), F.lit(0))
    if mode == "first":
        return first
    inside = F.filter(F.array(*(F.when(above[k], F.struct(F.col(f"p_{m}").cast("double").alias("p"), F.lit(-k).alias("k"))) for k, m in enumerate(names, 1))), lambda s: s.isNotNull())
    ranked = F.sort_array(inside, asc=False)
    return F.when(F.size(inside) <= 1, first).when(F.round(ranked[0]["p"] - F.get(ranked, F.lit(1))["p"], 6) > margin, -ranked[0]["k"]).otherwise(first)


def class_percentages(px: DataFrame, cls: str, n: int, by: str = "scene_id") -> DataFrame:
    """``pct_0 .. pct_n`` of each scene's pixels."""
    return px.groupBy(by).agg(*((F.avg((F.col(cls) == k).cast("int")) * 100).alias(f"pct_{k}") for k in range(n + 1)))


def refine_iteratively(px: DataFrame, score: Callable[[DataFrame], DataFrame], rounds: int = 2, value: str = "p") -> DataFrame:
    """Score, cut at 0.5, add the distance inside the mask as ``inside_distance``, score again; ``rounds`` times."""
    from groundmill.operators.curate import inside_distance

    px = score(px.withColumn("inside_distance", F.lit(0.0)))
    for _ in range(rounds):
        masked = px.withColumn("mask", (F.col(value) > 0.5).cast("int")).drop("inside_distance")
        px = score(inside_distance(masked).drop(value, "mask"))
    return px
