"""Structured Streaming over the event table: watermarks, windows, sessions and keyed state.

Each function takes a streaming (or batch) frame with ``event_id, ts, user_id, event_type, value`` and gives the
transformed frame; ``run`` drains a file source into a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import shared_dir, tidy_at_exit

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_trigger: int = 1) -> DataFrame:
    df = spark.readStream.schema(SCHEMA).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def deduplicated(df: DataFrame, late: str = "1 hour") -> DataFrame:
    return df.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def tumbling(df: DataFrame, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    g = df.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(df: DataFrame, size: str = "2 hours", step: str = "1 hour", late: str = "1 hour") -> DataFrame:
    g = df.withWatermark("ts", late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")


def sessions(df: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    g = df.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def burst_alarms(df: DataFrame, least: int = 3, size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    g = df.withWatermark("ts", late).groupBy(F.window("ts", size, "30 minutes").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.where(F.col("n") >= least).select("user_id", F.col("w.start").alias("start"), "n")


class CapAlarm(StatefulProcessor):
    """Keeps the running sum of a key and whether it was warned; one row out when the sum first reaches 95 % of the cap."""

    def __init__(self, cap: float):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("spent", "total double, warned boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        total, warned = self.state.get() if self.state.exists() else (0.0, False)
        for f in rows:
            total += float(f["value"].fillna(0).sum())
        warn = not warned and total >= 0.95 * self.cap
        self.state.update((total, warned or warn))
        if warn:
            yield pd.DataFrame({"user_id": [key[0]]})

    def close(self) -> None:
        pass


def cap_alarms(df: DataFrame, cap: float = 500.0) -> DataFrame:
    """One alarm per user, when the running sum of values first reaches 95 percent of ``cap``. Needs the state store
    that keeps values per key, see ``run``."""
    return df.groupBy("user_id").transformWithStateInPandas(CapAlarm(cap), "user_id long", "Append", "None")


STORE = "spark.sql.streaming.stateStore.providerClass"
BY_KEY = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def in_slices(spark: SparkSession, events: DataFrame, slices: int = 6) -> str:
    """A folder with the events as so many files in order of their time, as they would arrive; one batch each."""
    base = f"{shared_dir(spark)}/threadloom/arrivals-{uuid.uuid4().hex}"
    tidy_at_exit(spark, base)
    lo, hi = (x.timestamp() for x in events.agg(F.min("ts"), F.max("ts")).first())
    at = F.col("ts").cast("timestamp").cast("double")
    part = F.least(F.floor((at - lo) / ((hi - lo) / slices or 1)), F.lit(slices - 1)).cast("int")
    sliced = events.withColumn("part", part)
    for k in range(slices):  # arrival: one file after the other
        sliced.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(base)
    return base


def run(spark: SparkSession, folder: str, transform: Callable[[DataFrame], DataFrame], mode: str = "append", pattern: str = "*.parquet") -> DataFrame:
    """Drains the files there are through ``transform``, one file a batch, into a table in the shared folder and reads
    it back. In append mode rows come out once the watermark has passed them."""
    base = f"{shared_dir(spark)}/threadloom/stream-{uuid.uuid4().hex}"
    tidy_at_exit(spark, base)
    out, marks = f"{base}/out", f"{base}/marks"
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, BY_KEY)
    try:
        df = transform(read(spark, folder, pattern))
        w = df.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", marks)
        if mode == "append":
            q = w.format("parquet").option("path", out).start()
        else:  # complete results replace each other
            q = w.foreachBatch(lambda b, _: b.write.mode("overwrite").parquet(out)).start()
        q.awaitTermination()
    finally:
        spark.conf.set(STORE, before)
    return spark.read.schema(df.schema).parquet(out)
