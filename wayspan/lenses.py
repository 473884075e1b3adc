"""Views that present general tables as transit data, by integer arithmetic only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions from ``events``, with a replay of every tenth row as true duplicates."""
    e, u = F.col("event_id"), F.col("user_id")
    feed = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    p = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), e.alias("snapshot_key"), F.lit(0).alias("entity_idx"), feed.alias("feed_ts"), (feed - e * 37 % 180).alias("veh_ts"),
        u.cast("string").alias("vehicle_id"), ((u % 2) * 180 + e * 53 % 60).cast("int").alias("bearing"),
        (e * 7919 % 1009 % 500).cast("int").alias("x"), (e * 104729 % 1013 % 500).cast("int").alias("y"), (F.floor(F.col("value") * 10) % 3000).cast("int").alias("speed_cms"),
        (u % 30).cast("int").alias("route_id"), F.concat_ws("_", u.cast("string"), (e % 3).cast("string"), (u % 2).cast("string")).alias("trip_id"),
    )
    return p.unionByName(p.where("snapshot_key % 10 = 0").withColumn("snapshot_key", F.col("snapshot_key") + 10_000_000))


POSITIONS = """
base AS (SELECT CAST(ts AS DATE) AS day, event_id AS snapshot_key, CAST(floor(epoch(ts)) AS BIGINT) AS feed_ts,
  CAST(floor(epoch(ts)) AS BIGINT) - event_id * 37 % 180 AS veh_ts, CAST(user_id AS VARCHAR) AS vehicle_id,
  CAST(user_id % 2 * 180 + event_id * 53 % 60 AS INTEGER) AS bearing, CAST(event_id * 7919 % 1009 % 500 AS INTEGER) AS x,
  CAST(event_id * 104729 % 1013 % 500 AS INTEGER) AS y, CAST(floor(value * 10) AS BIGINT) % 3000 AS speed_cms,
  CAST(user_id % 30 AS INTEGER) AS route_id, user_id || '_' || event_id % 3 || '_' || user_id % 2 AS trip_id FROM events),
positions AS (SELECT * FROM base UNION ALL SELECT * REPLACE (snapshot_key + 10000000 AS snapshot_key) FROM base WHERE snapshot_key % 10 = 0)"""


def cells_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speed samples with day, selection axes and cell, from ``lineitem``."""
    o = F.col("l_orderkey")
    day = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        day.alias("day"), F.date_format(day, "yyyy-MM").alias("month"), F.when(F.weekday(day) < 5, "wd").otherwise("we").alias("daytype"), (o % 24).cast("int").alias("hour"),
        (F.floor(F.col("l_partkey") / 7) % 20).cast("int").alias("cx"), (F.floor(F.col("l_suppkey") / 3) % 20).cast("int").alias("cy"),
        ((F.col("l_linenumber") % 2) * 4 + o % 2).cast("int").alias("dir"), F.col("l_quantity").cast("int").alias("kmh"),
    )


CELLS = """
cells_long AS (SELECT CAST(l_shipdate AS DATE) AS day, strftime(l_shipdate, '%Y-%m') AS month,
  CASE WHEN isodow(CAST(l_shipdate AS DATE)) < 6 THEN 'wd' ELSE 'we' END AS daytype, CAST(l_orderkey % 24 AS INTEGER) AS hour,
  CAST(l_partkey // 7 % 20 AS INTEGER) AS cx, CAST(l_suppkey // 3 % 20 AS INTEGER) AS cy,
  CAST(l_linenumber % 2 * 4 + l_orderkey % 2 AS INTEGER) AS dir, CAST(floor(l_quantity) AS INTEGER) AS kmh FROM lineitem)"""


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops on paths, from ``supplier``: a path for each nation, in order of key."""
    s = F.col("s_suppkey")
    by = W.partitionBy("s_nationkey").orderBy("s_suppkey")
    k = F.row_number().over(by) - 1
    n = F.count("*").over(W.partitionBy("s_nationkey"))
    return table(spark, sf_dir, "supplier").select(s.alias("stop_id"), F.col("s_nationkey").cast("int").alias("route_id"), (s * 613 % 500).cast("int").alias("x"), (s * 389 % 500).cast("int").alias("y"), k.alias("k"), ((k == 0) | (k == n - 1)).alias("is_terminal"))


STOPS = """
stops AS (SELECT s_suppkey AS stop_id, CAST(s_nationkey AS INTEGER) AS route_id, CAST(s_suppkey * 613 % 500 AS INTEGER) AS x, CAST(s_suppkey * 389 % 500 AS INTEGER) AS y,
  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) IN (1, count(*) OVER (PARTITION BY s_nationkey)) AS is_terminal FROM supplier)"""
