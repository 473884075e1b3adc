"""Percentiles of sparse histograms: centre of the first bin whose running count reaches the target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expr import bin_centre


def percentiles(hist: DataFrame, keys: list[str], qs: dict[str, float], width: float = 1.0) -> DataFrame:
    """One row for each key with a column for each quantile; all share one sort.

    target = max(1, ceil(total * q)); an even split takes the lower bin.
    """
    h = hist.groupBy(*keys, "bin").agg(F.sum("n").alias("n")).where("n > 0")
    by = W.partitionBy(*keys)
    h = h.withColumns({"__cum": F.sum("n").over(by.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)), "__all": F.sum("n").over(by)})
    found = [bin_centre(F.min(F.when(F.col("__cum") >= F.greatest(F.lit(1), F.ceil(F.col("__all") * F.lit(float(q)))), F.col("bin"))), width).alias(name) for name, q in qs.items()]
    return h.groupBy(*keys).agg(*found)
