"""Filling containers of fixed capacity: bulk-synchronous best fit.

Sizes are token counts under a public tokenizer. A text above the capacity is cut into pieces of the
capacity and a rest; nothing else is cut. Each round

1. range-sorts the open gaps and the items not yet placed by size, from large to small, equal sizes spread by
   hash so that a frequent size does not land in one task;
2. sweeps every range by itself: an item takes the smallest gap of the range that holds it, and what is left of
   the gap goes back among the gaps of the range;
3. matches what ranges leave over, gaps of larger ranges with items of smaller ones. Only one pair of counts per
   range goes to the driver, which pairs them like brackets; the k-th item and the k-th gap of a pair of
   stretches meet by their rank, so no two items ask for one gap;
4. opens new containers: at first one for each item above half the capacity, then, before a round, what the
   sum of the remaining sizes asks for beyond the room there is.

Rounds repeat until every item has its container: the largest item left always has a gap that holds it, so each
round places one at least. Gaps too small for the smallest item left are closed.
"""

from __future__ import annotations

import base64
import bisect
import functools
import os

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Stage, ship_file

CAPACITY = 2048
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the split pattern that goes with the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def encoder(path: str):
    import tiktoken

    from pyspark import SparkFiles

    there = SparkFiles.get(os.path.basename(path))  # as sent by the driver; else the path itself
    with open(there if os.path.exists(there) else path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """Tokens of the whole text; null counts 0. The vocabulary file is sent to the executors."""
    ship_file(path)

    @F.arrow_udf("long")
    def count(t: pa.Array) -> pa.Array:
        enc = encoder(path)
        return pa.array([len(enc.encode_ordinary(s)) if s else 0 for s in t.to_pylist()], pa.int64())

    return count(text)


def _sweep(sizes: np.ndarray, is_gap: np.ndarray, ids: np.ndarray, floor: int) -> tuple[list, list, list]:
    """Best fit inside one range, scanning from large to small (gaps before items of their size).

    ``(placed (item, gap, room left before), leftover gaps (gap, room), leftover items)``, where the room kept
    on the stack is always at least the size of whatever comes next, so its smallest entry fits best.
    """
    room: list[tuple[int, int]] = []  # ascending (room, gap)
    placed, items = [], []
    for s, g, i in zip(sizes.tolist(), is_gap.tolist(), ids.tolist()):
        if g:
            bisect.insort(room, (s, i))
            continue
        k = bisect.bisect_left(room, (s, -(1 << 62)))
        if k == len(room):
            items.append((i, s))
            continue
        r, gap = room.pop(k)
        placed.append((i, gap, s))
        if r - s >= max(floor, 1):
            bisect.insort(room, (r - s, gap))
    # only rooms within the range's own sizes surely hold the items of later ranges
    least = int(sizes[-1]) if len(sizes) else 0
    return placed, [x for x in room[::-1] if x[0] >= least], items


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, per_range: int = 50_000) -> DataFrame:
    """``items (key, size)`` -> ``(key, piece, size, container, place)``, place counting from 1 in a container.

    Items with null key or null, zero or negative size take no room and get no row. An item larger than the
    capacity is cut into full pieces, which fill a container each, and a rest. Repeated keys are items of
    their own. Empty input gives no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    spark = items.sparkSession
    st = Stage(spark, "packing")
    base = items.select(F.col(key).alias("key"), F.col(size).cast("long").alias("size")).where("key is not null and size > 0")
    n = F.ceil(F.col("size") / capacity).cast("int")
    base = base.withColumn("piece", F.explode(F.sequence(F.lit(1), n)))
    base = base.withColumn("size", F.least(F.lit(capacity), F.col("size") - (F.col("piece") - 1) * capacity))
    base = st.cut(base.withColumn("id", F.monotonically_increasing_id()))

    # items above half the capacity share with no other of their kind: each opens a container at once
    big = base.where(F.col("size") * 2 > capacity)
    done = [big.select("id", F.col("id").alias("container"), F.lit(0).alias("round"), F.lit(0).cast("long").alias("seq"))]
    gaps = st.cut(big.select(F.col("id").alias("gap"), (F.lit(capacity) - F.col("size")).alias("room")).where("room > 0"))
    todo = st.cut(base.where(F.col("size") * 2 <= capacity).select("id", "size"))
    schema = "kind int, id long, gap long, size long, part int, rank long"
    opened, before, rnd = -1, 0, 0  # containers without a big item have numbers of their own, below zero

    while True:
        rnd += 1
        left = todo.agg(F.count("*").alias("n"), F.min("size").alias("least"), F.max("size").alias("most"), F.sum("size").alias("total")).first()
        if not left.n:
            break
        gaps = gaps.where(F.col("room") >= left.least)
        free = gaps.agg(F.sum("room").alias("s"), F.max("room").alias("m"), F.count("*").alias("n")).first()
        lacking = left.total - (free.s or 0)
        if lacking > 0 or (free.m or 0) < left.most or (rnd > 3 and left.n > 0.7 * before):
            # open what the items ask for beyond the room there is; one at least where no gap holds the largest
            k = max(1, lacking // capacity)
            fresh = spark.range(opened - k + 1, opened + 1).select(F.col("id").alias("gap"), F.lit(capacity).cast("long").alias("room"))
            opened -= k
            gaps = gaps.unionByName(fresh)
        before = left.n
        floor = int(left.least)
        events = gaps.select(F.lit(1).alias("kind"), F.col("gap").alias("id"), F.col("room").alias("size")).unionByName(todo.select(F.lit(0).alias("kind"), "id", "size"))
        events = events.withColumn("h", F.xxhash64("id"))
        partitions = int(-(-(left.n + (free.n or 0)) // per_range))  # as many ranges as keep each to `per_range` rows
        ordered = events.repartitionByRange(partitions, F.desc("size"), F.desc("kind"), "h").sortWithinPartitions(F.desc("size"), F.desc("kind"), "h")

        def sweep(frames, floor=floor):
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            parts = list(frames)  # one range
            if not parts:
                return
            f = pd.concat(parts)
            placed, room, rest = _sweep(f["size"].to_numpy(), f["kind"].to_numpy() == 1, f["id"].to_numpy(), floor)
            rows = [(2, i, g, s, part, k) for k, (i, g, s) in enumerate(placed)]
            rows += [(1, g, g, r, part, k) for k, (r, g) in enumerate(room)]
            rows += [(0, i, i, s, part, k) for k, (i, s) in enumerate(rest)]
            yield pd.DataFrame(rows, columns=["kind", "id", "gap", "size", "part", "rank"])

        swept = st.cut(ordered.select("kind", "id", "size").mapInPandas(sweep, schema))
        count = {(r.part, r.kind): r.n for r in swept.where("kind < 2").groupBy("part", "kind").agg(F.count("*").alias("n")).collect()}
        # ranges from large to small: items left over meet the latest gaps left over before them
        stack: list[list[int]] = []  # [part, first free rank from the end, gaps free]
        meet: list[tuple[int, int, int, int, int]] = []  # item part, item rank from, gap part, gap rank from, length
        for p in sorted({p for p, _ in count}):
            need, at = count.get((p, 0), 0), 0
            while need and stack:
                q, end = stack[-1]
                k = min(need, end)
                # the last gaps of a range have the least room
                meet.append((p, at, q, end - k, k))
                stack[-1][1] -= k
                if not stack[-1][1]:
                    stack.pop()
                need, at = need - k, at + k
            if count.get((p, 1), 0):
                stack.append([p, count[(p, 1)]])
        cross = None
        if meet:
            m = spark.createDataFrame([(*x, i) for i, x in enumerate(meet)], "ip int, ia long, gp int, ga long, len long, m int")  # at most two rows per range
            a = swept.where("kind = 0").join(F.broadcast(m), (F.col("part") == F.col("ip")) & (F.col("rank") >= F.col("ia")) & (F.col("rank") < F.col("ia") + F.col("len"))).select("m", (F.col("rank") - F.col("ia")).alias("k"), "id", "size")
            b = swept.where("kind = 1").join(F.broadcast(m), (F.col("part") == F.col("gp")) & (F.col("rank") >= F.col("ga")) & (F.col("rank") < F.col("ga") + F.col("len"))).select("m", (F.col("rank") - F.col("ga")).alias("k"), F.col("id").alias("gap"))
            cross = st.cut(a.join(b, ["m", "k"]).select("id", "gap", "size"))
        placed = swept.where("kind = 2").select("id", "gap", "size", "rank")
        if cross is not None:
            placed = placed.unionByName(cross.withColumn("rank", F.lit(1 << 40).cast("long")))
        placed = st.cut(placed)
        done.append(placed.select("id", F.col("gap").alias("container"), F.lit(rnd).alias("round"), F.col("rank").alias("seq")))
        used = placed.groupBy("gap").agg(F.sum("size").alias("used"))
        gaps = gaps.join(used, "gap", "left").select("gap", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")).where("room > 0")
        gaps = st.cut(gaps)
        todo = st.cut(todo.join(placed.select("id"), "id", "left_anti"))

    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    w = Window.partitionBy("container").orderBy("round", "seq", "id")  # at most `capacity` items each
    out = out.withColumn("place", F.row_number().over(w))
    return out.join(base, "id").select("key", "piece", "size", "container", "place")
