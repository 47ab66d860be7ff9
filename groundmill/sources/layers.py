"""Catalogs, pixel and tile scans, polygon folders, GeoJSON, per-scene sinks."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scene_catalog(spark: SparkSession, path: str, glob: str = "*.tif", exclude: str = "_prob.tif") -> DataFrame:
    """``(path, stem, bytes)`` of files, without probability rasters; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.where(~F.col("path").endswith(exclude)).select("path", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1).alias("stem"), F.col("length").alias("bytes")).orderBy("path")


def pair_sidecars(a: DataFrame, b: DataFrame, on: str = "stem") -> DataFrame:
    """Each file of ``a`` with the file of equal stem in ``b``; ``missing`` where there is none."""
    other = b.select(F.col(on), F.col("path").alias("sidecar"))
    return a.join(other, on, "left").withColumn("missing", F.col("sidecar").isNull())


def read_pixels(spark: SparkSession, path: str, bands: list[str] | None = None, scenes: list | None = None) -> DataFrame:
    """Pixels of some bands and scenes; both reach the scan."""
    px = spark.read.parquet(path)
    px = px if scenes is None else px.where(F.col("scene_id").isin(*scenes))
    return px if bands is None else px.select("scene_id", "y", "x", *bands)


def write_tiles(tiles: DataFrame, path: str, files: int = 200) -> None:
    """Tiles in a layout that reads prune: sorted by scene and grid place, so files and row groups hold few scenes and rows.

    Scenes are dealt out by range, so one with many tiles spreads over several files.
    """
    tiles.repartitionByRange(files, "scene_id", "grid_i", "grid_j").sortWithinPartitions("scene_id", "grid_i", "grid_j").write.parquet(path)


def read_tiles(spark: SparkSession, path: str, columns: list[str] | None = None, scenes: list | None = None, rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None) -> DataFrame:
    """Tiles of some scenes and grid ranges (both ends included) with some columns; all of it reaches the scan.

    The statistics of ``write_tiles``' files let the scan skip row groups of other scenes and places.
    """
    tiles = spark.read.parquet(path)
    tiles = tiles if scenes is None else tiles.where(F.col("scene_id").isin(*scenes))
    for name, ends in (("grid_i", rows), ("grid_j", cols)):
        tiles = tiles if ends is None else tiles.where(F.col(name).between(*ends))
    return tiles if columns is None else tiles.select("scene_id", "grid_i", "grid_j", *columns)


def read_polygon_folder(spark: SparkSession, path: str) -> DataFrame:
    """All layers under a folder, with where each row came from, a priority per file in path order, and a running id.

    Ids run within a file and start after the rows of the files before it, so no task numbers all rows.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(path).select("*", F.col("_metadata.file_path").alias("source_path"), F.monotonically_increasing_id().alias("_m"))
    rows = rows.where(F.col("ring").isNotNull() & (F.size("ring") >= 3))
    files = rows.groupBy("source_path").agg(F.count("*").alias("_n"))
    w = Window.orderBy("source_path")  # a row per file
    ranked = files.select("source_path", (F.dense_rank().over(w) - 1).alias("file_priority"), (F.sum("_n").over(w) - F.col("_n")).alias("_before"))
    named = rows.join(ranked, "source_path").withColumn("global_id", F.col("_before") + F.row_number().over(Window.partitionBy("source_path").orderBy("_m")) - 1)
    folder, file = F.regexp_extract("source_path", r"([^/]*)/[^/]*$", 1), F.regexp_extract("source_path", r"([^/]*)$", 1)
    return named.withColumn("source_folder", folder).withColumn("source_file", file).drop("_m", "_before")


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """Polygon features of FeatureCollections; ``properties`` is their DDL. The outer ring is ``ring``, others ``holes``."""
    schema = f"features array<struct<properties:struct<{properties}>,geometry:struct<type:string,coordinates:array<array<array<double>>>>>>"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
    rings = F.transform("f.geometry.coordinates", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return rows.select("f.properties.*", rings[0].alias("ring"), F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0))).alias("holes"))


def write_geojson(polys: DataFrame, path: str, ring: str = "ring") -> None:
    """One FeatureCollection per part file, a feature per line, so no task holds more than it writes."""
    pairs = F.transform(F.concat(F.col(ring), F.slice(F.col(ring), 1, 1)), lambda p: F.array(p["x"], p["y"]))
    props = F.struct(*(F.col(c) for c in polys.columns if c not in (ring, "holes", "bbox")))
    feature = F.struct(F.lit("Feature").alias("type"), props.alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(pairs).alias("coordinates")).alias("geometry"))

    def collection(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = '{"type":"FeatureCollection","features":['
        for batch in batches:
            lines = batch["value"].to_pylist()
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array([before + lines[0], *("," + x for x in lines[1:])])], ["value"])
                before = ","
        if before == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]}"])], ["value"])

    polys.select(F.to_json(feature).alias("value")).mapInArrow(collection, "value string").write.text(path)


def write_attributes_csv(polys: DataFrame, path: str) -> None:
    """All columns but shapes."""
    polys.drop("ring", "holes", "bbox", "geometry").write.option("header", "true").csv(path)


def write_by_scene(df: DataFrame, path: str, by: str = "scene_id") -> None:
    """A folder per scene; rows of a scene are dealt together first, so that it gets few files."""
    df.repartition(by).write.partitionBy(by).parquet(path)


def with_tags(df: DataFrame, tags: Mapping[str, str | Column]) -> DataFrame:
    """``df`` with a map of what made it: model, threshold, class name and the like."""
    keys = F.array(*(F.lit(k) for k in tags))
    return df.withColumn("tags", F.map_from_arrays(keys, F.array(*((v if isinstance(v, Column) else F.lit(v)).cast("string") for v in tags.values()))))
