"""Working tables in the folder that all executors share.

``settled`` cuts a plan's lineage by writing it there.  Tables made within a
``scope`` go when it ends; those made outside go when Python does.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_scopes: list[list[tuple[SparkSession, str]]] = [[]]
_own: dict[str, str] = {}  # application -> a folder of ours, where none is set and all runs on one machine


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``), with its scheme.

    Unset, a local master gets a temporary folder; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        app = spark.sparkContext.applicationId
        root = _own.get(app) or _own.setdefault(app, tempfile.mkdtemp(prefix="wayspan-"))
        if "://" not in root:
            root = f"file://{root}"
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return re.sub(r"^file:/(?!/)", "file:///", full).rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder name below the shared root, owned by the innermost scope."""
    path = f"{shared_root(spark)}/{what}-{uuid.uuid4().hex}"
    _scopes[-1].append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder through Hadoop's file system, from the driver."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _sweep(made: list[tuple[SparkSession, str]]) -> None:
    for spark, path in made:
        with contextlib.suppress(Exception):  # the session may be gone
            delete_path(spark, path)


@atexit.register
def _sweep_all() -> None:
    for made in _scopes:
        _sweep(made)


class Scope:
    def result(self, df: DataFrame) -> DataFrame:
        """``df`` written to a table that outlives the scope."""
        spark = df.sparkSession
        path = f"{shared_root(spark)}/table-{uuid.uuid4().hex}"
        _scopes[-2].append((spark, path))
        return _written(df, path)


@contextlib.contextmanager
def scope() -> Iterator[Scope]:
    """Tables settled within go at its end; what is returned must have been written by ``result``."""
    made: list[tuple[SparkSession, str]] = []
    _scopes.append(made)
    try:
        yield Scope()
    finally:
        _scopes.remove(made)
        _sweep(made)


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")  # for this write alone: its shuffle files go with it, not at the next garbage collection
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """Cut the lineage: written once as Parquet in the shared folder, where a lost executor takes nothing along."""
    return _written(df, scratch(df.sparkSession, "table"))
