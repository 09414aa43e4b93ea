"""Counter tables of fixed size, added up over all partitions of a table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 1 << 16


def slot_counts(df: DataFrame, size: int, add: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """``size`` counters over all rows: ``add(batch, counters)`` adds one batch.

    A partition hands on its counters above zero as rows, which are summed by slot like any other key: no task
    sees the counters of more than its share of slots, and the driver gets ``size`` rows at most.
    """

    def run(batches):
        acc = np.zeros(size, np.int64)
        for b in batches:
            add(b, acc)
        at = np.flatnonzero(acc)
        for lo in range(0, len(at), PART):
            part = at[lo : lo + PART]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(acc[part])], names=["slot", "n"])

    summed = df.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[summed.column("slot").to_numpy()] = summed.column("n").to_numpy()
    return out
