"""Burning of rings and lines against plain geometry in fractions, boxes of unlike sizes, and the plans behind them."""

import random
from fractions import Fraction as Q

from pyspark.sql import functions as F

from conftest import DATA
import groundmill.plans.more_queries  # noqa: F401  registers its queries
import groundmill.plans.vector_queries  # noqa: F401  registers its queries
from groundmill.operators import focal, labels, metrics, normalize, regions, spatial
from groundmill.plans.queries import QUERIES


def _ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def _frame(spark, rings):
    return spark.createDataFrame(rings, "id long, ring array<struct<x:double,y:double>>")


def _burnt(points):
    """Cells whose open inside a side meets, and cells whose centre lies inside: each cell of the bounding box by itself."""
    pts = [(Q(x), Q(y)) for x, y in points]
    sides = list(zip(pts, pts[1:] + pts[:1]))
    inside, touched = set(), set()
    for y in range(int(min(p[1] for p in pts)) - 2, int(max(p[1] for p in pts)) + 3):
        for x in range(int(min(p[0] for p in pts)) - 2, int(max(p[0] for p in pts)) + 3):
            cx, cy = x + Q(1, 2), y + Q(1, 2)
            if sum((a[1] > cy) != (b[1] > cy) and cx < a[0] + (b[0] - a[0]) * (cy - a[1]) / (b[1] - a[1]) for a, b in sides if a[1] != b[1]) % 2:
                inside.add((y, x))
            for a, b in sides:
                lo, hi, meets = Q(0), Q(1), True
                for k, c in ((0, x), (1, y)):
                    d = b[k] - a[k]
                    if d == 0:
                        meets = meets and c < a[k] < c + 1
                    else:
                        t = sorted(((c - a[k]) / d, (c + 1 - a[k]) / d))
                        lo, hi = max(lo, t[0]), min(hi, t[1])
                if meets and (lo < hi or a == b):
                    touched.add((y, x))
    return inside, touched | inside


def test_rings_of_any_shape_burn_as_cell_by_cell(spark):
    draw = random.Random(7)
    shapes = [[(Q(draw.randint(-40, 40), 8), Q(draw.randint(-40, 40), 8)) for _ in range(draw.randint(3, 9))] for _ in range(40)]
    shapes += [[(0, 0), (4, 0), (4, 4), (0, 4)], [(0, 0), (6, 0), (6, 2), (2, 2), (2, 6), (0, 6)], [(Q(1, 2), Q(1, 2))], [(1, 1)], [(0, Q(1, 2)), (5, Q(1, 2))], [(3, 0), (3, 4)]]
    polys = _frame(spark, [(i, _ring(s)) for i, s in enumerate(shapes)])
    for touched in (False, True):
        got = {}
        for r in labels.rasterize(polys, "id", all_touched=touched).collect():
            got.setdefault(r["id"], set()).add((r["y"], r["x"]))
        for i, s in enumerate(shapes):
            assert got.get(i, set()) == _burnt(s)[touched], (i, touched, s)


def test_rings_null_empty_repeated_and_of_one_id(spark):
    square, other = _ring([(0, 0), (2, 0), (2, 2), (0, 2)]), _ring([(1, 1), (3, 1), (3, 3), (1, 3)])
    polys = _frame(spark, [(1, square), (1, square), (1, other), (2, None), (3, []), (None, square)])
    got = [(r["id"], r["y"], r["x"]) for r in labels.rasterize(polys, "id").collect()]
    assert len(got) == len(set(got))
    assert {(y, x) for i, y, x in got if i == 1} == {(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (2, 1), (2, 2)}
    assert {i for i, _, _ in got} == {1, None}
    assert labels.rasterize(polys.limit(0), "id").count() == 0


def test_thin_long_shapes_cost_their_length(spark):
    """A sliver across 20,000 x 20,000 cells: 400 million cells in its bounding box."""
    far = 20_000
    sliver = _frame(spark, [(1, _ring([(0.25, 0.125), (far + 0.25, far + 0.125), (far + 0.5, far + 0.625)]))])
    assert far <= labels.rasterize(sliver, "id").count() <= 4 * far
    line = spark.createDataFrame([(0.25, 0.5, far + 0.25, far + 0.5)], "x0 double, y0 double, x1 double, y1 double")
    assert far <= labels.burn_lines(line, 1.0).count() <= 5 * far


def test_one_box_over_the_plane_is_few_rows(spark):
    small = [(i, float(i % 300) * 7, float(i // 300) * 7, float(i % 300) * 7 + 3, float(i // 300) * 7 + 2) for i in range(3000)]
    large = [(-1, -1e7, -1e7, 1e7, 1e7), (-2, 100.0, -50.0, 1100.0, 40.0), (-3, 12.0, 0.0, 12.0, 0.0), (-4, 21.5, 3.0, 30.0, 3.5)]
    frame = lambda rows: spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double").withColumn("bbox", spatial.box()).select("id", "bbox")
    a, b = frame(large), frame(small)
    for pad in (0.0, 4.5):
        want = {(p[0], q[0]) for p in large for q in small if p[1] - pad <= q[3] and q[1] <= p[3] + pad and p[2] - pad <= q[4] and q[2] <= p[4] + pad}
        got = [tuple(r) for r in spatial.candidate_pairs(a, b, "id", "id", 1.0, pad).collect()]
        back = [tuple(r) for r in spatial.candidate_pairs(b, a, "id", "id", 1.0, pad).collect()]
        assert len(got) == len(set(got)) == len(want) and set(got) == want
        assert len(back) == len(want) and {(q, p) for p, q in back} == want
    levels = spatial._pairs_of_levels(b.unionByName(a), "bbox", 1.0)
    assert levels.count() <= spatial.LEVELS**2
    spread = spatial._spread(a, "_la", "_lb", levels, 1.0, "bbox").groupBy("id").count()
    assert {r["id"]: r["count"] for r in spread.collect()}[-1] <= 4 * 2**2 + 81 * spatial.LEVELS  # 4e14 cells of the finest grid


def test_boxes_without_values_meet_nothing(spark):
    rows = [(1, None, 0.0, 1.0, 1.0), (2, 0.0, 0.0, 1.0, 1.0)]
    b = spark.createDataFrame(rows, "id long, x0 double, y0 double, x1 double, y1 double").withColumn("bbox", spatial.box()).select("id", "bbox")
    assert [tuple(r) for r in spatial.candidate_pairs(b, b, "id", "id", 1.0).collect()] == [(2, 2)]
    assert spatial.candidate_pairs(b, b.limit(0), "id", "id", 1.0).count() == 0


def test_irregularity_of_a_block_and_an_angle(spark):
    block = {(y, x) for y in range(4) for x in range(5)}
    angle = {(y, 10) for y in range(6)} | {(5, x) for x in range(10, 16)}
    px = spark.createDataFrame([(0, y, x, int((y, x) in block | angle or (y, x) == (9, 0))) for y in range(12) for x in range(20)], "scene_id long, y long, x long, mask int")
    got = {(r["y"], r["x"]): r["irregularity"] for r in regions.with_irregularity(px, "mask", 5, 4).collect()}
    assert {got[c] for c in block} == {0.0} and got[(9, 0)] == got[(11, 19)] == 0.0 and len(got) == 240
    (one,) = {round(got[c], 9) for c in angle}
    # Hull of the angle: the 6 x 6 square less the triangle over five cells.
    assert one == round(1 - 11 / (36 - 12.5) * 11 / 36, 9)


def test_sobel_norms_share_their_edges(spark):
    plan = QUERIES["sobel_norms"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6
    for name in ("burn_rings", "burn_lines", "burn_lines_px", "zones_of_all_sizes"):
        plan = QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_nulls_make_edges_null_and_lines_shorter_than_a_kernel_fold(spark):
    px = spark.createDataFrame([(0, y, x, None if (y, x) == (0, 0) else float(x)) for y in range(4) for x in range(4)], "scene_id long, y long, x long, v double")
    edges = {(r["y"], r["x"]): r["edge"] for r in normalize.sobel(px, F.col("v")).collect()}
    assert {c for c, e in edges.items() if e is None} == {(0, 0), (0, 1), (1, 0), (1, 1)} and edges[(3, 3)] == 0.5**0.5
    tiny = spark.createDataFrame([(0, 0, x, float(x)) for x in range(2)], "scene_id long, y long, x long, v double")
    got = {r["x"]: r["s"] for r in focal.shifted_sum(tiny, "v", "s", {-3: 1.0, 0: 10.0, 3: 100.0}, "x").collect()}
    # Mirrored with the edge repeated, places -3 to 4 read 1 1 0 0 1 1 0 0.
    assert got == {0: 1.0, 1: 11.0}


def test_rolling_loss_of_one_stage_is_many_blocks(spark):
    """Blocks shorter than, as long as and longer than the window, batches with gaps and ties, null losses and stages."""
    draw = random.Random(3)
    rows = [(draw.choice(["a", "b", None]) if i % 5 == 0 else "a", i // 2 * 3, None if i % 11 == 0 else float(draw.randint(0, 99))) for i in range(400)]
    log = spark.createDataFrame(rows, "stage string, batch long, loss double")
    want = []
    for stage in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == stage), key=lambda r: (r[1], r[2] is not None, r[2] or 0))
        for i, r in enumerate(mine):
            some = [x[2] for x in mine[max(0, i - 6) : i + 1] if x[2] is not None]
            want.append((str(stage), r[1], str(r[2]), round(sum(some) / len(some), 9) if some else None))
    for block in (1, 7, 10, 64, 1000):
        got = [(str(r["stage"]), r["batch"], str(r["loss"]), r["rolling"] if r["rolling"] is None else round(r["rolling"], 9)) for r in metrics.rolling_loss(log, 7, block=block).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), block
    assert metrics.rolling_loss(log.limit(0)).count() == 0
