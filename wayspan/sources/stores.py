"""Folders by date, as-of choice of schedules, and mirrors of parquet folders.

Any store that Hadoop knows (file, hdfs, s3a, ...) works: listings go through its
file system on the driver, data through Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = re.compile(r"\d{4}-\d{2}-\d{2}")
#: Kinds of daily tables that a mirror carries.
KINDS = ("agg", "hist", "seg", "seghist")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is absent."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def dates(spark: SparkSession, path: str) -> list[str]:
    """Folders named YYYY-MM-DD (or day=YYYY-MM-DD)."""
    found = (n.removeprefix("day=").removeprefix("static_date=") for n in names(spark, path))
    return [n for n in found if DATE.fullmatch(n)]


def snapshot_files(spark: SparkSession, path: str, day: str) -> list[str]:
    """A day's snapshots in order of time: their names sort so."""
    return [f"{path}/{day}/{n}" for n in names(spark, f"{path}/{day}") if n.endswith(".pb")]


def static_date_for(day: str, available: list[str]) -> str | None:
    """The newest archive not after ``day``, else the oldest, else None."""
    past = [d for d in available if d <= day]
    return max(past) if past else min(available, default=None)


def asof(days: DataFrame, available: DataFrame) -> DataFrame:
    """(day, static_date) for many days at once.

    Archives are few: the list travels as one array; nothing is joined by range.
    """
    a = available.select("static_date").distinct().agg(F.array_sort(F.collect_list("static_date")).alias("a"))
    past = F.filter("a", lambda d: d <= F.col("day"))
    return days.join(F.broadcast(a), F.lit(True)).select("day", F.coalesce(F.try_element_at(past, F.lit(-1)), F.try_element_at("a", F.lit(1))).alias("static_date"))


def mirror_plan(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(way, name): what to pull and what to push so that both sides have the same names."""
    pull = remote.join(local, "name", "left_anti").select(F.lit("pull").alias("way"), "name")
    push = local.join(remote, "name", "left_anti").select(F.lit("push").alias("way"), "name")
    return pull.unionByName(push)


def mirror(spark: SparkSession, source: str, target: str, kinds=KINDS) -> list[str]:
    """Copy what ``target`` lacks, a name at a time, complete files only (written aside, then renamed)."""
    done = []
    util = spark._jvm.org.apache.hadoop.fs.FileUtil
    conf = spark._jsc.hadoopConfiguration()
    for kind in kinds:
        have = set(names(spark, f"{target}/{kind}"))
        for name in names(spark, f"{source}/{kind}"):
            if name in have or name.startswith(("_", ".")):
                continue
            sfs, sp = _fs(spark, f"{source}/{kind}/{name}")
            tfs, tp = _fs(spark, f"{target}/{kind}/.{name}.part")
            tfs.mkdirs(tp.getParent())
            util.copy(sfs, sp, tfs, tp, False, conf)
            tfs.rename(tp, _fs(spark, f"{target}/{kind}/{name}")[1])
            done.append(f"{kind}/{name}")
    return done
