"""Tile grids, the pixels of each tile, tile checks, resampling and alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_grid(scenes: DataFrame, size: int, mode: str = "overlap", overlap: float = 0.0, stride: int | None = None) -> DataFrame:
    """``(scene_id, grid_i, grid_j, row_off, col_off, win_h, win_w)`` from ``scenes(scene_id, height, width)``.

    "overlap": step = size - int(size * overlap), tiles clipped at the edge and kept if both sides reach size // 2;
    "stride": ceil((dim - size) / stride) + 1 tiles; "plain": ceil(dim / size); "reflect": like "overlap" with
    ``overlap`` in cells, all tiles whole, their outside to be mirrored by ``reflect_cells``.
    """
    if mode == "stride" and (stride is None or stride <= 0):
        raise ValueError("stride must be positive")
    over = int(overlap) if mode == "reflect" else int(size * overlap)
    step = {"overlap": size - over, "reflect": size - over, "stride": stride, "plain": size}[mode]
    if step <= 0:
        raise ValueError("the overlap leaves no step")
    n = {
        "overlap": lambda d: F.ceil((F.col(d) - over) / step), "reflect": lambda d: F.ceil((F.col(d) - over) / step),
        "stride": lambda d: F.greatest(F.ceil((F.col(d) - size) / step), F.lit(0)) + 1, "plain": lambda d: F.ceil(F.col(d) / size),
    }[mode]
    index = lambda d: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(n(d), F.lit(1)).cast("long") - 1))
    grid = scenes.select("scene_id", "height", "width", index("height").alias("grid_i")).select("*", index("width").alias("grid_j"))
    grid = grid.withColumn("row_off", F.col("grid_i") * step).withColumn("col_off", F.col("grid_j") * step)
    side = lambda d, o: F.lit(size).cast("long") if mode == "reflect" else F.least(F.lit(size), F.col(d) - F.col(o)).cast("long")
    grid = grid.withColumn("win_h", side("height", "row_off")).withColumn("win_w", side("width", "col_off"))
    if mode == "overlap":
        grid = grid.where((F.col("win_h") >= size // 2) & (F.col("win_w") >= size // 2))
    return grid.where("win_h > 0 AND win_w > 0").drop("height", "width")


def assign_pixels_to_tiles(px: DataFrame, size: int, step: int, tiles: DataFrame | None = None) -> DataFrame:
    """Every pixel once for each tile that covers it, with ``ty, tx`` inside the tile; indices come from arithmetic.

    With ``tiles`` (a grid) only those tiles stay.
    """
    span = lambda c: F.sequence(F.greatest(F.ceil((F.col(c) - size + 1) / step), F.lit(0)).cast("long"), F.floor(F.col(c) / step).cast("long"))
    out = px.withColumn("grid_i", F.explode(span("y"))).withColumn("grid_j", F.explode(span("x")))
    out = out.withColumn("ty", F.col("y") - F.col("grid_i") * step).withColumn("tx", F.col("x") - F.col("grid_j") * step)
    return out if tiles is None else out.join(tiles.select("scene_id", "grid_i", "grid_j").hint("shuffle_hash"), ["scene_id", "grid_i", "grid_j"], "left_semi")


def reflect_cells(cells: DataFrame, size: int, height: Column, width: Column) -> DataFrame:
    """For tile cells (row, col) beyond the scene, the source (y, x): the mirror image without the edge repeated, folded as often as the tile needs."""

    def fold(p: Column, n: Column) -> Column:
        period = F.greatest(2 * (n - 1), F.lit(1))
        at = F.pmod(p, period)
        return F.when(n > 1, F.least(at, period - at)).otherwise(F.lit(0)).cast("long")

    return cells.withColumn("y", fold(F.col("row_off") + F.col("ty"), height)).withColumn("x", fold(F.col("col_off") + F.col("tx"), width))


def reflect_tiles(px: DataFrame, scenes: DataFrame, size: int, overlap: int) -> DataFrame:
    """Whole tiles of ``size`` cells, edges filled by mirror; ``px`` columns with grid_i, grid_j, ty, tx."""
    grid = tile_grid(scenes, size, "reflect", overlap).join(scenes, "scene_id")
    cells = grid.withColumn("ty", F.explode(F.sequence(F.lit(0), F.lit(size - 1)))).withColumn("tx", F.explode(F.sequence(F.lit(0), F.lit(size - 1))))
    placed = reflect_cells(cells, size, F.col("height"), F.col("width"))
    return placed.select("scene_id", "grid_i", "grid_j", "ty", "tx", "y", "x").hint("merge").join(px, ["scene_id", "y", "x"])


def assemble_tiles(cells: DataFrame, value: str, size: int) -> DataFrame:
    """``(scene_id, grid_i, grid_j, data)``: row-major arrays of size * size, missing cells 0."""
    held = cells.groupBy("scene_id", "grid_i", "grid_j").agg(F.map_from_entries(F.collect_list(F.struct((F.col("ty") * size + F.col("tx")).cast("int"), F.col(value).cast("float")))).alias("_m"))
    data = F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.coalesce(F.col("_m")[k], F.lit(0.0).cast("float")))
    return held.select("scene_id", "grid_i", "grid_j", data.alias("data"))


def explode_tiles(tiles: DataFrame, size: int, value: str = "v") -> DataFrame:
    cells = tiles.select("scene_id", "grid_i", "grid_j", F.posexplode("data").alias("_k", value))
    return cells.select("scene_id", "grid_i", "grid_j", F.floor(F.col("_k") / size).alias("ty"), (F.col("_k") % size).alias("tx"), value)


def drop_empty_tiles(cells: DataFrame, value: str, size: int, max_mean: float = 0.01) -> DataFrame:
    """Tiles whose mean over the padded tile reaches ``max_mean``."""
    keep = cells.groupBy("scene_id", "grid_i", "grid_j").agg((F.sum(value) / (size * size)).alias("_mean")).where(F.col("_mean") >= max_mean)
    return cells.join(keep.drop("_mean"), ["scene_id", "grid_i", "grid_j"], "left_semi")


def drop_mostly_zero(cells: DataFrame, value: str, share: float = 0.6) -> DataFrame:
    keep = cells.groupBy("scene_id", "grid_i", "grid_j").agg(F.avg((F.col(value) == 0).cast("int")).alias("_zero")).where(F.col("_zero") < share)
    return cells.join(keep.drop("_zero"), ["scene_id", "grid_i", "grid_j"], "left_semi")


def tile_quality(cells: DataFrame, bands: list[str], size: int | None = None) -> DataFrame:
    """``(scene_id, grid_i, grid_j, good)``: no band with p2 >= p98 or a null or NaN, and ``size`` * size cells if given."""
    fine = [F.max((F.col(b).isNull() | F.isnan(F.col(b).cast("double"))).cast("int")) == 0 for b in bands]
    spread = [F.percentile(b, F.lit(0.02)) < F.percentile(b, F.lit(0.98)) for b in bands]
    good = fine[0]
    for c in [*fine[1:], *spread, *([F.count("*") == size * size] if size else [])]:
        good = good & c
    return cells.groupBy("scene_id", "grid_i", "grid_j").agg(good.alias("good"))


def resample(px: DataFrame, scenes: DataFrame, value: str, zoom: float, method: str = "bilinear") -> DataFrame:
    """``(scene_id, y, x, <value>)`` on a grid of int(dim * zoom) cells from the same origin; a zoom within 0.01 of 1 changes nothing.

    Each new cell takes its one or four source cells by equi-join, clamped at the border. The new cells come of rows of
    scenes, by whose size Spark would take them for few and send all to the driver: the joins say that they are to merge.
    """
    if abs(zoom - 1) < 0.01:
        return px.select("scene_id", "y", "x", value)
    side = lambda d: F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor(F.col(d) * zoom), F.lit(1)).cast("long") - 1))
    dest = scenes.select("scene_id", "height", "width", side("height").alias("y")).select("*", side("width").alias("x"))
    return _sample(dest, px, value, (F.col("y") + 0.5) / zoom - 0.5, (F.col("x") + 0.5) / zoom - 0.5, method)


def _sample(dest: DataFrame, px: DataFrame, value: str, fy: Column, fx: Column, method: str) -> DataFrame:
    """``dest(scene_id, height, width, y, x)`` filled from ``px`` at the fractional places; height and width are the source's."""
    at = dest.withColumn("_fy", fy).withColumn("_fx", fx)
    clamp = lambda c, d: F.least(F.greatest(c, F.lit(0)), F.col(d) - 1).cast("long")
    source = px.select("scene_id", F.col("y").cast("long").alias("_sy"), F.col("x").cast("long").alias("_sx"), F.col(value).alias("_v"))
    if method == "nearest":
        near = at.withColumn("_sy", clamp(F.floor(F.col("_fy") + 0.5), "height")).withColumn("_sx", clamp(F.floor(F.col("_fx") + 0.5), "width"))
        return near.hint("merge").join(source, ["scene_id", "_sy", "_sx"]).select("scene_id", "y", "x", F.col("_v").alias(value))
    four = at.withColumn("_d", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)))))
    wy, wx = F.col("_fy") - F.floor("_fy"), F.col("_fx") - F.floor("_fx")
    weight = F.when(F.col("_d.i") == 1, wy).otherwise(1 - wy) * F.when(F.col("_d.j") == 1, wx).otherwise(1 - wx)
    near = four.withColumn("_w", weight).where("_w > 0").withColumn("_sy", clamp(F.floor("_fy") + F.col("_d.i"), "height")).withColumn("_sx", clamp(F.floor("_fx") + F.col("_d.j"), "width"))
    return near.hint("merge").join(source, ["scene_id", "_sy", "_sx"]).groupBy("scene_id", "y", "x").agg(F.sum(F.col("_w") * F.col("_v")).alias(value))


def align_to(px: DataFrame, scenes: DataFrame, reference: DataFrame, value: str, method: str = "nearest") -> DataFrame:
    """``value`` on the reference's grid; both scene tables hold scene_id, height, width and the affine ``transform``."""
    side = lambda d: F.explode(F.sequence(F.lit(0).cast("long"), F.col(d).cast("long") - 1))
    ref = reference.select("scene_id", F.col("transform").alias("_t"), F.col("height").alias("_h"), F.col("width").alias("_w"))
    both = ref.join(scenes.select("scene_id", "height", "width", F.col("transform").alias("_s")), "scene_id")
    dest = both.withColumn("y", side("_h")).withColumn("x", side("_w"))
    from groundmill.functions.pixels import pixel_to_world, world_to_pixel

    world = pixel_to_world(F.col("x") + 0.5, F.col("y") + 0.5, F.col("_t"))
    placed = dest.withColumn("_p", world).withColumn("_q", world_to_pixel(F.col("_p.x"), F.col("_p.y"), F.col("_s")))
    inside = (F.col("_q.row") >= 0) & (F.col("_q.row") < F.col("height")) & (F.col("_q.col") >= 0) & (F.col("_q.col") < F.col("width"))
    return _sample(placed.where(inside), px, value, F.col("_q.row") - 0.5, F.col("_q.col") - 0.5, method)


def clip_scene(px: DataFrame, y0: int, x0: int, y1: int, x1: int) -> DataFrame:
    """Pixels with y0 <= y < y1 and x0 <= x < x1; an empty box raises ``ValueError``."""
    if y0 >= y1 or x0 >= x1:
        raise ValueError("the bounds do not intersect")
    return px.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))


def crop_to_common(pred: DataFrame, gt: DataFrame) -> DataFrame:
    """Pixels that both hold."""
    return pred.join(gt, ["scene_id", "y", "x"])
