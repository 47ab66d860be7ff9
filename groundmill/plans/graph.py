"""Scratch tables and connected components, for operators that work in rounds."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_folders: dict[str, str] = {}
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``; it is removed when the driver ends.

    Where that setting is missing a temporary folder serves a local master (tests, a laptop); on a cluster, whose
    machines would not see each other's files, it is an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not root and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = root or tempfile.mkdtemp(prefix="groundmill-")
        _folders[app] = f"{root.rstrip('/')}/groundmill-{app}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def _remove(spark: SparkSession, folder: str) -> None:
    if spark.sparkContext._jsc is not None:  # else the session was stopped before
        _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here and a lost executor costs nothing.

    The shuffle files behind it go as soon as it is written, so an operator's disk is that of its widest step. With
    ``rows``, what it sorts, its shuffles have ``tasks_for`` them partitions, which Spark does not merge.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if rows is not None:
        settings |= {"spark.sql.shuffle.partitions": str(tasks_for(spark, rows)), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


#: Rows that one task sorts, in the steps that say how many tasks they take.
TASK_ROWS = 100_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a step over ``rows`` rows: one for each ``TASK_ROWS``, but enough to keep the cores busy.

    Spark merges partitions by their compressed bytes; rows of cells compress a hundredfold, so that a few megabytes
    there are gigabytes where they are sorted.
    """
    return max(-(-rows // TASK_ROWS), min(spark.sparkContext.defaultParallelism, -(-rows // 10_000)), 1)


def whole_groups(keys: Sequence[str], most: int = TASK_ROWS, first: str | None = None):
    """A function for ``mapInArrow`` tasks: batches sorted by ``keys`` become tables of whole groups with each row's group number.

    Where keys are not plain values, a group starts at each row in which the column ``first`` is 1. A table ends with the
    group in which ``most`` rows are reached. Made here so that it travels with its user's code.
    """
    keys = list(keys)

    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def groups(t):
            new = np.zeros(t.num_rows, bool)
            if first:
                new[1:] = t.column(first).to_numpy()[1:] == 1
            for k in keys:
                c = t.column(k).combine_chunks()
                a, b = c.slice(0, len(c) - 1), c.slice(1)
                other = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
                new[1:] |= other.to_numpy(zero_copy_only=False)
            return np.cumsum(new)

        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                t = pa.Table.from_batches(held).combine_chunks()
                g = groups(t)
                done = int(np.searchsorted(g, g[-1]))  # the last group may go on
                if done:
                    yield t.slice(0, done).combine_chunks(), g[:done]
                held = t.slice(done).combine_chunks().to_batches()
                rows = 0  # looked at again after as many rows more
        if held:
            t = pa.Table.from_batches(held).combine_chunks()
            yield t, groups(t)

    return cut


def free(*tables: DataFrame) -> None:
    """Delete the files of what ``stored`` returned. Nothing may read the tables later, nor what is made from them lazily."""
    for table in tables:
        _delete(table.sparkSession, _paths.pop(table))


def split_join(rows: DataFrame, totals: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ``rows`` with ``totals``, an aggregate of them by ``on``, that Spark can split where a key is hot.

    Joined on ``on`` alone the aggregate's partitions would serve the join as well, and Spark never splits such a join.
    A hash of the keys as one more of them gives both sides an exchange of their own, which AQE's skew join can split.
    """
    salt = F.xxhash64(*on)
    return rows.withColumn("_salt", salt).join(totals.withColumn("_salt", salt).hint("merge"), [*on, "_salt"]).drop("_salt")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; a component is named after its smallest node.

    Large-star and small-star rounds: every node's neighbours move to the smallest node known, so the number of
    rounds grows with the logarithm of the longest chain, and no step holds a node's neighbours in memory. Each
    round is written to the shared folder. Nodes are of any ordered type; null ends and loops are left out.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            break
        mark = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("w"))
        large = split_join(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("w").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("w"))
        small = split_join(large, low, ["u"]).where("v > w").select(F.col("v").alias("u"), F.col("w").alias("v"))
        before, now = now, stored(small.unionByName(low.select("u", F.col("w").alias("v"))).distinct())
        free(before)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def ranked_within(df: DataFrame, by: str, order: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with ``name``, 1, 2, .. within each value of ``by`` in the order of ``order``; equal rows in any order.

    Rows are dealt into ranges of (by, order) and numbered inside each, so one value may fill many tasks; summed up are
    only the ranges' counts, a row for each value in each range.
    """
    dealt = stored(df.repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_part", F.col(by).alias("_by")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_by").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select(F.col("_part").alias("_p"), "_by", F.coalesce(upto, F.lit(0)).alias("_before"))
    inside = dealt.withColumn("_place", F.row_number().over(Window.partitionBy("_part", by).orderBy(*order)))
    met = inside.join(before, (F.col("_part") == F.col("_p")) & F.col(by).eqNullSafe(F.col("_by")))
    return met.withColumn(name, F.col("_before") + F.col("_place")).drop("_part", "_p", "_by", "_before", "_place")
