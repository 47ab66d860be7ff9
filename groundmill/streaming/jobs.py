"""Structured Streaming jobs: scenes processed once as they arrive, running confusion counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_scene_stats(spark: SparkSession, path: str, schema: StructType, stats: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Each new pixel file under ``path`` once through ``stats``, appended to ``out`` with its batch number.

    A batch writes a folder named after it, so one that runs again after a failure replaces its own rows.
    """
    given = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)

    def save(batch: DataFrame, number: int) -> None:
        stats(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return given.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_whole_scenes(spark: SparkSession, path: str, schema: StructType, whole: Column, stats: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """One row set per scene from ``stats``, once all of the scene's files are there, however many batches bring them.

    ``whole`` is a column over one scene's pixels so far, an aggregate such as ``F.count("*") >= F.max("height") *
    F.max("width")``: true once nothing is missing. Batch n keeps the pixels of scenes that are not whole in
    ``checkpoint/pending/batch=n`` and reads those of batch n - 1, so a batch that runs again after a failure, or in a
    new session, meets the same pixels and replaces its own rows. Pixels that arrive for a scene after it was reported
    are left out; cells that come twice count once. Waiting pixels stay distributed: no task holds a scene.
    """
    given = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    jvm = spark.sparkContext._jvm

    def there(folder: str) -> bool:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def drop(folder: str) -> None:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def save(batch: DataFrame, number: int) -> None:
        pending, done = f"{checkpoint}/pending", f"{checkpoint}/done"
        px = batch
        if number and there(f"{pending}/batch={number - 1}"):
            px = px.unionByName(spark.read.schema(schema).parquet(f"{pending}/batch={number - 1}"))
        px = px.dropDuplicates(["scene_id", "y", "x"])
        if there(done):
            earlier = spark.read.schema(f"scene_id {dict(px.dtypes)['scene_id']}, batch long").parquet(done).where(F.col("batch") < number)
            px = px.join(earlier.select("scene_id"), "scene_id", "left_anti")
        px.write.mode("overwrite").parquet(f"{checkpoint}/met/batch={number}")
        met = spark.read.schema(schema).parquet(f"{checkpoint}/met/batch={number}")
        ready = met.groupBy("scene_id").agg(whole.alias("_whole")).where("_whole").select("scene_id")
        ready.write.mode("overwrite").parquet(f"{done}/batch={number}")
        ready = spark.read.parquet(f"{done}/batch={number}")
        met.join(ready, "scene_id", "left_anti").write.mode("overwrite").parquet(f"{pending}/batch={number}")
        stats(met.join(ready, "scene_id", "left_semi")).write.mode("overwrite").parquet(f"{out}/batch={number}")
        for old in (f"{pending}/batch={number - 2}", f"{checkpoint}/met/batch={number}"):
            drop(old)

    return given.writeStream.foreachBatch(save).option("checkpointLocation", f"{checkpoint}/offsets").trigger(availableNow=True).start()


def stream_confusion(pixels: DataFrame, pred: Column, gt: Column, by: str = "scene_id") -> DataFrame:
    """A streaming (or batch) table of ``tp, fp, fn, tn`` per scene, for update or complete mode."""
    p, g = F.coalesce(pred > 0, F.lit(False)), F.coalesce(gt > 0, F.lit(False))
    return pixels.groupBy(by).agg(F.count_if(p & g).alias("tp"), F.count_if(p & ~g).alias("fp"), F.count_if(~p & g).alias("fn"), F.count_if(~p & ~g).alias("tn"))
