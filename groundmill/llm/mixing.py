"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundmill.llm.common import word_count

#: Documents of one source and size are dealt into this many runs, so that no window holds a hot source.
RUNS = 256


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, size)``, one row per source, null last.

    Sources in code-point order take the weights in turn. All targets sum to ``share`` of all sizes, a target
    stops at ``most`` times its source, and the excess goes to the others by weight: with the sources ordered by
    the level at which they fill, target = least(most * size, level * weight) for one common level.
    Only one row per source is ordered here; the documents never are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    places = F.array(*(F.lit(w) for w in weights))
    named = (
        sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
        .withColumn("weight", F.element_at(places, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("double"))
        .withColumn("stop", F.col("source_size") * F.lit(float(most)))
    )
    filling = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    levels = (
        named.withColumn("wanted", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("spent", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("wanted") - F.col("spent")) / F.col("open"))
        .withColumn("fits", F.col("stop") <= F.col("level") * F.col("weight"))
        .withColumn("common", F.min(F.when(~F.col("fits"), F.struct(F.col("stop") / F.col("weight"), F.col("level")))).over(every)["level"])
    )
    return levels.select("source", "source_size", F.when(F.col("fits") | F.col("common").isNull(), F.col("stop")).otherwise(F.least("stop", F.col("common") * F.col("weight"))).alias("target"))


def _offset(source: Column, seed: int) -> Column:
    """The source's random start in [0, 1)."""
    text = F.concat(F.lit(f"{seed}/"), F.coalesce(F.concat(F.lit("="), source), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[k])
    return on


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)``: how often the mix takes each document; columns of ``carry`` come last.

    Every document of a source expects f = target / source_size copies. The source's documents, ordered by size,
    carry the running sum of f plus one random start, and a document is taken once for each integer that its part
    of the sum crosses; so it gets floor(f) or ceil(f) copies and neighbours of like size share the rounding, which
    leaves a source within about one document of its target. The running sum needs only a document's rank: counts
    are summed over a source's larger sizes, then over the runs before in one size, and a window ranks inside one
    run; so the widest window holds a source's distinct sizes and a hot source costs no hot task. A null text has size 0; equal rows are interchangeable; a source of size 0 has
    target 0 and takes nothing; null is a source of its own, ordered last.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *carry)
    runs = sized.withColumn("run", F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 2), 16, 10).cast("int") % RUNS)
    groups = runs.groupBy("source", "size", "run").count()
    by_size = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    by_run = Window.partitionBy("source", "size").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(groups.select("source", (F.col("size") * F.col("count")).alias("size")), weights, share, most)
    larger = groups.groupBy("source", "size").agg(F.sum("count").alias("n")).withColumn("larger", F.coalesce(F.sum("n").over(by_size), F.lit(0))).drop("n")
    starts = groups.withColumn("earlier", F.coalesce(F.sum("count").over(by_run), F.lit(0))).drop("count")
    starts = starts.join(larger, _same(starts, larger, ["source", "size"])).select(starts["source"], starts["size"], "run", (F.col("larger") + F.col("earlier")).alias("before"))
    starts = starts.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    inside = runs.withColumn("place", F.row_number().over(Window.partitionBy("source", "size", "run").orderBy("doc_id", *carry)))
    placed = inside.join(starts, _same(inside, starts, ["source", "size", "run"])).select(
        "doc_id", inside["source"], inside["size"], "source_size", "target",
        (F.col("before") + F.col("place")).cast("double").alias("rank"),
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"), *carry,
    )
    start = _offset(F.col("source"), seed)
    copies = F.floor(F.col("rank") * F.col("rate") + start) - F.floor((F.col("rank") - 1) * F.col("rate") + start)
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), *carry)


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS stop,
         ((SELECT sum(source_size) FROM named)::DOUBLE * 1.5::DOUBLE
          - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0)) / ((SELECT sum(weight) FROM named) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM named WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (SELECT arg_min(level, stop / weight) AS level FROM levels WHERE NOT stop <= level * weight),
targets AS (
  SELECT source, source_size,
         CASE WHEN stop <= levels.level * weight OR common.level IS NULL THEN stop ELSE least(stop, common.level * weight) END AS target,
         (('0x' || substr(md5('7/' || coalesce('=' || source, 'null')), 1, 8))::BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u
  FROM levels, common),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2), doc_id)::DOUBLE AS rank FROM sized),
rated AS (
  SELECT doc_id, size, t.source_size, t.target, t.u, rank, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(rank * rate + u) - floor((rank - 1) * rate + u) AS BIGINT) AS taken FROM rated
"""
