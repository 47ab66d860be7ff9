"""Embedding near-dedup: an exact metric range join over pivot cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundmill.llm.common import connected_components, join_labels, map_arrow, sorted_groups, stored
from groundmill.llm.vectors import matrix, sample, usable, width_of

#: At most this many pivots, chosen from at most PIVOT_SAMPLE vectors; vectors a cell should hold; rows of a block.
PIVOTS, PIVOT_SAMPLE, CELL, BLOCK = 512, 8192, 8192, 8192
EMPTY = np.zeros(0, np.int64)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest entry near one: exact, and no square over- or underflows."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None]) if len(vectors) and vectors.shape[1] else vectors


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other, greedily: each next pivot is the one farthest from those chosen."""
    if not len(vectors) or count < 1:
        return vectors[:0]
    chosen, gap = [0], ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(vectors)) and gap.max() > 1e-12:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return vectors[chosen]


def cells_of(unit: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The home cell of each unit vector, and ``(row, cell)`` of the earlier cells that it must visit.

    A vector's home is its nearest pivot. If y lives with pivot q and x is within ``radius`` of y, then
    d(x, q) <= d(x, p) + 2 * radius for every pivot p, x's own included, by the triangle inequality twice; so x goes
    to every cell q for which that holds. As y is no nearer to p than to q, x is also at most ``radius`` beyond the
    plane half-way between the two: d(x, q)^2 - d(x, p)^2 <= 2 * radius * d(p, q). Of two cells the pair is found in
    the earlier one only.
    """
    away = np.sqrt(np.maximum(2 - 2 * unit @ pivots.T, 0))
    home = away.argmin(axis=1)
    visit = away <= away.min(axis=1)[:, None] + 2 * radius + 1e-9
    between = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))
    visit &= away**2 - away.min(axis=1)[:, None] ** 2 <= 2 * radius * between[home] + 1e-6
    row, cell = np.nonzero(visit & (np.arange(len(pivots)) < home[:, None]))
    return home, row, cell


def _compare(table: pa.Table, width: int, cosine: float) -> pa.RecordBatch:
    """Links of each work unit, as counts per vector and edges that connect them."""
    unit = table["unit"].to_numpy()
    rep, own, side, weight = (table[c].to_numpy() for c in ("rep", "visitor", "side", "weight"))
    vectors = scaled(matrix(table["embedding"], width))
    length = np.sqrt((vectors * vectors).sum(axis=1))
    links = np.zeros(len(unit), np.int64)
    ends_a, ends_b = [], []
    starts = np.append(np.flatnonzero(np.diff(unit, prepend=unit[0] - 1)), len(unit))
    for lo, hi in zip(starts, starts[1:], strict=False):
        at = np.arange(lo, hi)
        left, right = at[side[lo:hi] != 1], at[side[lo:hi] != 0]  # side 2: both, a block against itself
        for cut in range(0, len(left), 512):
            a = left[cut : cut + 512]
            near = vectors[a] @ vectors[right].T >= cosine * length[a][:, None] * length[right]
            near &= rep[a][:, None] != rep[right]
            i, j = np.nonzero(near)
            i, j = a[i], right[j]
            np.add.at(links, i, weight[j])
            if side[lo] != 2:
                np.add.at(links, j, weight[i])
            ends_a.append(i)
            ends_b.append(j)
    label = join_labels(len(unit), np.concatenate([*ends_a, EMPTY]), np.concatenate([*ends_b, EMPTY]))
    some = np.flatnonzero(links > 0)
    return pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.array(links[some]), pa.array(rep[label[some]])], ["rep", "links", "joined"])


def near_vectors(vectors: DataFrame, cosine: float = 0.9, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id)``: how many other vectors have at least this cosine, and the group they form.

    On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c). Pivots (a bounded sample's
    farthest points, as many as keep cells at ``cell`` vectors, PIVOTS at most) partition the vectors; the triangle
    inequality says which earlier cells a vector visits; cells join on their own, in pairs of blocks of ``block`` rows,
    in double precision on the original vectors. A block pair passes on a count per vector and edges enough to
    connect its links, never the links themselves.

    Equal vectors are one row with a weight, and link with each other. Null, zero and non-finite vectors link with
    nothing; all others are scaled by powers of two first, so any magnitude is compared. Vectors of unequal length compare as if padded with zeros. Rows of one vec_id and equal vector count
    once; with unequal vectors, each counts, under the id's one result. Rows without vec_id get null results.
    """
    fine = usable(vectors).distinct()
    width = width_of(fine)
    classes = stored(fine.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")))
    count = classes.count()
    radius = float(np.sqrt(2 - 2 * cosine))
    drawn = scaled(sample(classes.withColumnRenamed("rep", "vec_id"), PIVOT_SAMPLE, width))
    drawn = drawn / np.sqrt((drawn * drawn).sum(axis=1))[:, None]
    pivots = choose_pivots(drawn, min(PIVOTS, -(-count // cell)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = scaled(matrix(batch["embedding"], width))
            home, row, cell = cells_of(v / np.sqrt((v * v).sum(axis=1))[:, None], pivots, radius)
            every = np.concatenate([np.arange(len(v)), row])
            told = np.concatenate([np.zeros(len(v), np.int32), np.ones(len(row), np.int32)])
            cols = [batch[c].take(pa.array(every)) for c in ("rep", "weight", "embedding")]
            out = pa.Table.from_arrays([*cols, pa.array(np.concatenate([home, cell]).astype(np.int32)), pa.array(told)], ["rep", "weight", "embedding", "cell", "visitor"])
            yield from out.to_batches(max_chunksize=4096)

    placed = map_arrow(classes.select("rep", "weight", "embedding"), place, "rep long, weight long, embedding array<double>, cell int, visitor int")
    # One row per pivot: at most PIVOTS rows.
    sizes = F.broadcast(placed.groupBy("cell").agg(F.sum(1 - F.col("visitor")).alias("homes"), F.sum("visitor").alias("visits")))
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / F.lit(block)).cast("int"), F.lit(1))
    dealt = placed.join(sizes, "cell").withColumn("h", blocks("homes")).withColumn("v", blocks("visits"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("visitor") == 0, F.col("h")).otherwise(F.col("v"))).cast("int")
    part = lambda kind, a, b, side: F.struct(F.xxhash64("cell", F.lit(kind), a, b).alias("unit"), side.alias("side"))
    n = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    home_units = F.concat(
        F.transform(n("h"), lambda k: part(0, F.least("own", k), F.greatest("own", k), F.when(k == F.col("own"), 2).when(F.col("own") < k, 0).otherwise(1))),
        F.when(F.col("visits") > 0, F.transform(n("v"), lambda k: part(1, F.col("own"), k, F.lit(0)))).otherwise(F.array().cast("array<struct<unit:bigint,side:int>>")),
    )
    visit_units = F.transform(n("h"), lambda k: part(1, k, F.col("own"), F.lit(1)))
    units = dealt.withColumn("own", own).select("rep", "weight", "embedding", "visitor", F.explode(F.when(F.col("visitor") == 0, home_units).otherwise(visit_units)).alias("u"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_groups(batches, "unit"):
            yield _compare(table, width, cosine)

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = units.select("u.unit", "u.side", "rep", "weight", "visitor", "embedding").repartition(parts, "unit").sortWithinPartitions("unit")
    found = stored(map_arrow(work, join, "rep long, links long, joined long"))
    groups = connected_components(found.select(F.col("rep").alias("a"), F.col("joined").alias("b")))
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    by_class = classes.join(totals, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left").select("embedding", "rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    by_id = fine.join(by_class, "embedding").groupBy("vec_id").agg(F.sum("n").alias("n"), F.min("c").alias("c"))
    every = vectors.select("vec_id").join(by_id, "vec_id", "left")
    given = F.col("vec_id").isNotNull()
    return every.select("vec_id", F.when(given, F.coalesce("n", F.lit(0))).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(d, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT links.b, reach.c FROM reach JOIN links ON reach.d = links.a WHERE reach.c < links.b),
least_of AS (SELECT d, min(c) AS c FROM reach GROUP BY d),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept FROM embeddings JOIN least_of ON d = vec_id LEFT JOIN counts ON a = vec_id
"""
