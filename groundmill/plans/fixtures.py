"""Views over the driver tables: scenes of pixels, parcels, detections, tiles and batch losses.

The SQL of each view is the same in Spark and in DuckDB, so a query and its oracle read the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Name: (table it reads, SQL over that table).
VIEWS = {
    "px": ("orders", """
SELECT CAST(floor(o_orderkey / 1500) AS BIGINT) AS scene_id, CAST(floor((o_orderkey % 1500) / 50) AS BIGINT) AS y, o_orderkey % 50 AS x,
       (o_orderkey * 7919 + o_custkey * 104729) % 256 AS r, (o_custkey * 31 + o_orderkey * 17) % 256 AS g, (o_custkey * 131 + o_orderkey * 7) % 256 AS b,
       (CAST(floor(o_totalprice) AS BIGINT) % 1024) / CAST(1024 AS DOUBLE) AS p_building, (o_custkey * 37 % 1024) / CAST(1024 AS DOUBLE) AS p_vegetation,
       (o_orderkey * 61 % 1024) / CAST(1024 AS DOUBLE) AS p_water, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS gt,
       CASE WHEN o_custkey % 97 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(20 AS DOUBLE) + (o_custkey % 64) / CAST(16 AS DOUBLE) END AS dem
FROM orders"""),
    "parcel": ("part", """
SELECT p_partkey AS parcel_id, (p_partkey % 50) * 4 AS x0, CAST(floor(p_partkey / 50) AS BIGINT) * 4 AS y0,
       (p_partkey % 50) * 4 + 2 + p_size % 4 AS x1, CAST(floor(p_partkey / 50) AS BIGINT) * 4 + 2 + p_size % 3 AS y1,
       p_brand AS rs_no, CASE WHEN p_partkey % 11 = 0 THEN CAST(NULL AS VARCHAR(20)) ELSE p_type END AS category
FROM part"""),
    "det": ("orders", """
SELECT o_orderkey AS det_id, (o_orderkey * 37) % 200 AS x0, CAST(floor(o_orderkey / 94) AS BIGINT) + o_custkey % 4 AS y0,
       (o_orderkey * 37) % 200 + 1 + o_orderkey % 3 AS x1, CAST(floor(o_orderkey / 94) AS BIGINT) + o_custkey % 4 + 1 + o_custkey % 2 AS y1,
       o_custkey % 5 AS file_priority
FROM orders"""),
    "epoch_log": ("events", """
SELECT event_id AS batch, CAST(floor(event_id / 100) AS BIGINT) AS epoch, event_type AS stage, value AS loss FROM events"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view over the tables in ``sf_dir``."""
    table, sql = VIEWS[name]
    given = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.replace(f"FROM {table}", "FROM {given}").strip(), given=given)


def with_views(sql: str) -> str:
    """DuckDB SQL in which the view names stand for their definitions."""
    views = ", ".join(f"{n} AS ({q})" for n, (_, q) in VIEWS.items())
    rest = sql.strip()
    return f"WITH RECURSIVE {views}" + (", " + rest[len("WITH ") :] if rest.startswith("WITH ") else " " + rest)
