"""Reports and accuracy: acreage summaries, confusion counts and what follows from them, training-log windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.operators.focal import focal_max
from groundmill.plans.graph import ranked_within


def area_summary(polys: DataFrame, group: str, area: str) -> DataFrame:
    """Sum, count, least, largest and mean area of each group, largest sum first."""
    return polys.groupBy(group).agg(
        F.sum(area).alias("total"), F.count(area).alias("polygons"), F.min(area).alias("least"), F.max(area).alias("largest"), F.avg(area).alias("mean")
    ).orderBy(F.desc("total"), group)


def overall_summary(polys: DataFrame, group: str, area: str) -> DataFrame:
    return polys.agg(F.count_distinct(group).alias("groups"), F.count("*").alias("polygons"), F.sum(area).alias("total"), F.avg(area).alias("mean"), F.min(area).alias("least"), F.max(area).alias("largest"))


def count_by_source(polys: DataFrame, source: str) -> DataFrame:
    return polys.groupBy(source).count().orderBy(F.desc("count"), source)


def polygon_stats(polys: DataFrame, area: str, rectangularity: str | None = None) -> DataFrame:
    from groundmill.functions.pixels import size_class

    kind = size_class(F.col(area) / 10000)
    more = [F.avg(rectangularity).alias("mean_rectangularity")] if rectangularity else []
    return polys.agg(F.sum(area).alias("total"), F.avg(area).alias("mean"), F.max(area).alias("largest"), F.min(area).alias("least"), *more, *(F.count_if(kind == k).alias(k) for k in ("small", "medium", "large")))


def workflow_summary(results: dict[str, DataFrame], acres: str = "acres") -> DataFrame:
    """A row per result: its count, and its acres as text, "N/A" where it has no such column."""
    rows = [df.agg(F.lit(n).alias("result"), F.count("*").alias("rows"), (F.coalesce(F.round(F.sum(acres), 4).cast("string"), F.lit("0.0")) if acres in df.columns else F.lit("N/A")).alias("acres")) for n, df in results.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def confusion(px: DataFrame, pred: Column, gt: Column, by: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, fn, tn, total`` of two masks, set where above 0."""
    p, g = F.coalesce(pred > 0, F.lit(False)), F.coalesce(gt > 0, F.lit(False))
    return px.groupBy(*by).agg(F.count_if(p & g).alias("tp"), F.count_if(p & ~g).alias("fp"), F.count_if(~p & g).alias("fn"), F.count_if(~p & ~g).alias("tn"), F.count("*").alias("total"))


def scores(eps: float | None = None) -> dict[str, Column]:
    """iou, dice, f1, precision, recall from counts: zero denominators give 0, rounded to 4; with ``eps`` it is added to both ends."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def ratio(a: Column, b: Column) -> Column:
        return (a + eps) / (b + eps) if eps else F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 4)

    return {"iou": ratio(tp, tp + fp + fn), "dice": ratio(2 * tp, 2 * tp + fp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn)}


def binary_metrics(batches: DataFrame, p: Column, gt: Column, by: Sequence[str] = (), cut: float = 0.5, eps: float = 1e-7) -> DataFrame:
    """Counts over all batches with probabilities cut at ``cut``, then the scores; partial counts merge by addition."""
    return confusion(batches, (p > cut).cast("int"), gt, by).withColumns(scores(eps))


def multiclass_iou(px: DataFrame, probs: Sequence[str], truth: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by, cls, tp, fp, fn, iou)``; the predicted class is the first of the largest probabilities."""
    p = F.array(*(F.col(c) for c in probs))
    told = px.select(*by, (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("_p"), F.col(truth).cast("int").alias("_t"))
    sides = told.select(*by, F.explode(F.array_distinct(F.array("_p", "_t"))).alias("cls"), "_p", "_t")
    counts = sides.groupBy(*by, "cls").agg(F.count_if((F.col("_p") == F.col("cls")) & (F.col("_t") == F.col("cls"))).alias("tp"), F.count_if((F.col("_p") == F.col("cls")) & (F.col("_t") != F.col("cls"))).alias("fp"), F.count_if((F.col("_p") != F.col("cls")) & (F.col("_t") == F.col("cls"))).alias("fn"))
    return counts.withColumn("iou", F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)))


def per_image(px: DataFrame, p: Column, gt: Column, by: Sequence[str] = ("scene_id",), smooth: float = 1.0) -> DataFrame:
    """One row: the mean over images of soft IoU and Dice."""
    sums = px.groupBy(*by).agg(F.sum(p * gt).alias("i"), F.sum(p).alias("p"), F.sum(gt).alias("g"))
    return sums.agg(F.avg((F.col("i") + smooth) / (F.col("p") + F.col("g") - F.col("i") + smooth)).alias("iou"), F.avg((2 * F.col("i") + smooth) / (F.col("p") + F.col("g") + smooth)).alias("dice"))


def boundary_f1(px: DataFrame, pred: str, gt: str, theta0: int = 3, theta: int = 5, eps: float = 1e-7) -> DataFrame:
    """``(scene_id, precision, recall, f1)`` of boundaries: the largest of 1 - x around a cell minus its own, widened by ``theta``."""
    for name, mask in (("p", pred), ("g", gt)):
        px = px.withColumn("_i", 1 - F.col(mask))
        px = focal_max(px, "_i", theta0, "_m").withColumn(f"_{name}b", F.col("_m") - F.col("_i"))
        px = focal_max(px, f"_{name}b", theta, f"_{name}w")
    sums = px.groupBy("scene_id").agg(F.sum(F.col("_pb") * F.col("_gw")).alias("a"), F.sum("_pb").alias("b"), F.sum(F.col("_gb") * F.col("_pw")).alias("c"), F.sum("_gb").alias("d"))
    out = sums.select("scene_id", (F.col("a") / (F.col("b") + eps)).alias("precision"), (F.col("c") / (F.col("d") + eps)).alias("recall"))
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + eps))


def rolling_loss(log: DataFrame, n: int = 50, by: str = "stage", block: int = 100_000) -> DataFrame:
    """``rolling``: the mean of the last ``n`` losses of the stage; equal batches follow one another by their loss, null losses are left out.

    A stage is cut into blocks of ``block`` rows, each with copies of the n - 1 rows before it, so one long stage is many tasks.
    """
    size = max(block, n)
    ranked = ranked_within(log, by, ("batch", "loss"), "_rank").withColumn("_own", F.floor((F.col("_rank") - 1) / size))
    late = (F.col("_rank") - 1) % size > size - n
    copied = ranked.withColumn("_block", F.explode(F.when(late, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    last = Window.partitionBy(by, "_block").orderBy("_rank").rowsBetween(1 - n, 0)
    return copied.withColumn("rolling", F.avg("loss").over(last)).where("_block = _own").drop("_rank", "_own", "_block")


def early_stop(log: DataFrame, value: str = "loss", patience: int = 10, larger: bool = False, by: str = "stage") -> DataFrame:
    """``(by, epoch, value, best, since, stop)``: the best so far, epochs since it, and whether the run has stopped by then."""
    w = Window.partitionBy(by).orderBy("epoch")
    so_far = w.rowsBetween(Window.unboundedPreceding, -1)
    f = F.max if larger else F.min
    gain = F.coalesce(F.col(value) > f(value).over(so_far) if larger else F.col(value) < f(value).over(so_far), F.lit(True))
    marked = log.withColumn("_gain", gain.cast("int")).withColumn("_run", F.sum("_gain").over(w))
    since = marked.withColumn("since", F.row_number().over(Window.partitionBy(by, "_run").orderBy("epoch")) - 1)
    best = since.withColumn("best", f(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return best.withColumn("stop", F.max((F.col("since") >= patience).cast("int")).over(w) == 1).select(by, "epoch", value, "best", "since", "stop")


def best_epoch(log: DataFrame, value: str = "loss", larger: bool = False, by: str = "stage") -> DataFrame:
    """The first epoch of the best value of each stage."""
    pick = F.max_by if larger else F.min_by
    return log.groupBy(by).agg(pick("epoch", F.struct(value, -F.col("epoch") if larger else F.col("epoch"))).alias("epoch"), (F.max if larger else F.min)(value).alias(value))


def top_regions(regions: DataFrame, n: int, size: str = "cells", then: str = "region") -> DataFrame:
    return regions.orderBy(F.desc(size), then).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def union_layers(*layers: DataFrame) -> DataFrame:
    """All layers' rows with all layers' columns."""
    out = layers[0]
    for layer in layers[1:]:
        out = out.unionByName(layer, allowMissingColumns=True)
    return out


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()
