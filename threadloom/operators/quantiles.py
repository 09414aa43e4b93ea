"""Percentiles by rank, in the definitions that differ by a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sampling


def _rank(method: str, n: Column, q: float) -> Column:
    """1-based rank of the wanted row."""
    if method == "floor":  # sorted[min(n - 1, int(n * q))]
        return F.least(n, F.floor(n * F.lit(q)) + 1)
    if method == "nearest":  # ceil(q * n)
        return F.greatest(F.lit(1), F.ceil(n * F.lit(q)))
    if method == "round":  # round(q * (n - 1)), half to even
        return F.bround((n - 1) * F.lit(q)) + 1
    if method == "upper_middle":  # sorted[n // 2], whatever q
        return F.floor(n / 2) + 1
    raise ValueError(method)


def percentiles(df: DataFrame, c: Column, qs: list[float], method: str) -> DataFrame:
    """One row ``p50, p90, ...``. Values are counted first, so ranks are found among distinct values, whose counts
    are summed along the values by ranges."""
    counts = df.select(c.alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("k"))
    run = sampling.running(counts, "v", "k").withColumnRenamed("rn", "upto").join(F.broadcast(counts.agg(F.sum("k").alias("n"))))  # one row
    picks = [F.min(F.when(F.col("upto") >= _rank(method, F.col("n"), q), F.col("v"))).alias(f"p{round(q * 100)}") for q in qs]
    return run.agg(*picks)
