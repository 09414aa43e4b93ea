"""Splits, oversampling and quotas, by hash instead of by a random generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import Stage


def split_ab(key: Column, seed: int = 42) -> Column:
    return F.when(text.hash64_mod(F.concat(key, F.lit(f":{seed}")), 2) == 0, "A").otherwise("B")


def every_nth(df: DataFrame, order: str, n: int = 10) -> DataFrame:
    """Every n-th row of the order goes to ``eval``. Ranks come from counts per range, then within the range."""
    at = row_numbers(df, order)
    return at.withColumn("split", F.when((F.col("rn") - 1) % n == 0, "eval").otherwise("train"))


def running(df: DataFrame, order: str, weight: str | None = None, per_range: int = 1_000_000) -> DataFrame:
    """Adds ``rn``: the running sum of ``weight`` (1 without) up to every row in the order, this row included.

    The rows are written in ranges of about ``per_range`` rows; one sum per range goes to the driver, and each range
    goes on from the sum before it. No task sees more than a range, unless one value of the order fills it.
    """
    spark = df.sparkSession
    st = Stage(spark, "running")
    plain, n = st.cut_counted(df)
    w = F.col(weight) if weight else F.lit(1)
    if n <= per_range:  # one range, of a size just counted
        return plain.withColumn("rn", F.sum(w).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
    d = st.cut(plain.repartitionByRange(-(-n // per_range), order).withColumn("_part", F.spark_partition_id()))
    sums = {r._part: r.n for r in d.groupBy("_part").agg(F.sum(w).alias("n")).collect()}  # one row per range
    lead, rows = 0, []
    for p in sorted(sums):
        rows.append((p, lead))
        lead += sums[p]
    leads = spark.createDataFrame(rows, "_part int, _lead long")
    win = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return d.join(F.broadcast(leads), "_part").withColumn("rn", F.sum(w).over(win) + F.col("_lead")).drop("_part", "_lead")  # a row per range


def row_numbers(df: DataFrame, order: str, per_range: int = 1_000_000) -> DataFrame:
    """``rn``: the 1-based place of every row in the order, without one task seeing all rows."""
    return running(df, order, None, per_range)


def first_share(df: DataFrame, order: str, take: int) -> DataFrame:
    """The first ``take`` rows of the order, however many that is of the table."""
    return row_numbers(df, order).where(F.col("rn") <= take).drop("rn")


def copies(weight: Column, key: Column, seed: int = 13, most: float = 10.0) -> Column:
    """Copies of a row: the whole part of its weight, and one more with the chance of the fraction, by hash."""
    w = F.least(F.greatest(F.when(F.isnan(weight) | weight.isNull(), F.lit(1.0)).otherwise(weight), F.lit(1.0)), F.lit(most))
    chance = text.hash64_mod(F.concat(key, F.lit(f":{seed}")), 1_000_000) / F.lit(1e6)
    return (F.floor(w) + (chance < (w - F.floor(w))).cast("int")).cast("int")


def oversample(df: DataFrame, weight: Column, key: Column, seed: int = 13) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies(weight, key, seed))))


def largest_remainder(shares: dict[str, float], total: int, available: dict[str, int] | None = None) -> dict[str, int]:
    """Quotas in proportion to ``shares`` that sum to ``total``, the largest remainders rounded up. What a kind
    cannot fill out of ``available`` spills to the others by what they have left, until it is placed or nothing is left."""
    whole = sum(shares.values())
    if not whole:
        return dict.fromkeys(shares, 0)
    exact = {k: total * v / whole for k, v in shares.items()}
    out = {k: int(x) for k, x in exact.items()}
    for k in sorted(shares, key=lambda k: (out[k] - exact[k], k))[: total - sum(out.values())]:
        out[k] += 1
    if available is None:
        return out
    out = {k: min(v, available.get(k, 0)) for k, v in out.items()}
    missing = total - sum(out.values())
    for k in sorted(out, key=lambda k: (out[k] - available.get(k, 0), k)):
        more = min(missing, available.get(k, 0) - out[k])
        out[k] += more
        missing -= more
    return out


def capped(df: DataFrame, group: str, rank: Column, cap: int) -> DataFrame:
    """At most ``cap`` rows per group in order of ``rank``; rows without a group are not capped.

    Salted in two steps: first ``cap`` rows of each of 16 slices of a group, then of the group.
    """
    d = df.withColumn("_r", rank).withColumn("_s", F.pmod(F.xxhash64("_r"), F.lit(16)))
    w1 = Window.partitionBy(group, "_s").orderBy("_r")
    w2 = Window.partitionBy(group).orderBy("_r")
    some = d.where(F.col(group).isNotNull()).withColumn("_n", F.row_number().over(w1)).where(F.col("_n") <= cap)
    some = some.withColumn("_n", F.row_number().over(w2)).where(F.col("_n") <= cap)
    return some.unionByName(d.where(F.col(group).isNull()).withColumn("_n", F.lit(0))).drop("_r", "_s", "_n")


def stratified(df: DataFrame, by: list[str], rank: Column, per: int) -> DataFrame:
    d = df.withColumn("_r", rank).withColumn("_s", F.pmod(F.xxhash64("_r"), F.lit(16)))
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy(*by, "_s").orderBy("_r"))).where(F.col("_n") <= per)
    d = d.withColumn("stratum_rank", F.row_number().over(Window.partitionBy(*by).orderBy("_r"))).where(F.col("stratum_rank") <= per)
    return d.drop("_r", "_s", "_n")


def round_robin(targets: dict[str, int], available: dict[str, int], total: int) -> dict[str, int]:
    """Targets cut to what is available; what is missing to ``total`` is given out one by one, in the order of the
    names, to those that have more."""
    out = {k: min(v, available.get(k, 0)) for k, v in sorted(targets.items())}
    missing = total - sum(out.values())
    while missing > 0 and any(out[k] < available.get(k, 0) for k in out):
        for k in out:
            if missing > 0 and out[k] < available.get(k, 0):
                out[k] += 1
                missing -= 1
    return out


def equal_targets(names: list[str], total: int) -> dict[str, int]:
    """``total`` in equal parts, the first names getting one more."""
    names = sorted(names)
    return {k: total // len(names) + (i < total % len(names)) for i, k in enumerate(names)} if names else {}


def take(df: DataFrame, by: str, rank: Column, quotas: dict[str, int]) -> DataFrame:
    """The first ``quotas[kind]`` rows of every kind in order of ``rank``. Salted as in ``capped``; kinds are few."""
    if not quotas:
        return df.limit(0)
    quota = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))])
    d = df.where(F.col(by).isin(list(quotas))).withColumn("_r", rank).withColumn("_q", F.element_at(quota, F.col(by))).withColumn("_s", F.pmod(F.xxhash64("_r"), F.lit(16)))
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy(by, "_s").orderBy("_r"))).where(F.col("_n") <= F.col("_q"))
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy("_r"))).where(F.col("_n") <= F.col("_q"))
    return d.drop("_r", "_q", "_s", "_n")


def _firsts(d: DataFrame, by: list[str], n: Column) -> DataFrame:
    """The first ``n`` rows by ``_r`` of every group: of 16 slices of it first, then of the group."""
    d = d.withColumn("_s", F.pmod(F.xxhash64("_r"), F.lit(16)))
    d = d.withColumn("_n", F.row_number().over(Window.partitionBy(*by, "_s").orderBy("_r"))).where(F.col("_n") <= n)
    return d.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("_r"))).where(F.col("_n") <= n).drop("_s", "_n")


def greedy_quota(df: DataFrame, task: str, bucket: str, source: str, rank: Column, quotas: dict[str, int], cap: int) -> DataFrame:
    """Rows chosen per task: bucket by bucket in proportion to their sizes, in order of ``rank``, at most ``cap`` rows of
    a source over all buckets; what a bucket leaves open is filled from the rest in order of ``rank``.

    Which rows the cap takes depends on the rows before, so a task is decided in one place, from no more than three
    times its quota per bucket: more rows cannot be looked at.
    """
    d = df.where(F.col(task).isin(list(quotas))).withColumn("_r", rank)
    sizes: dict[str, dict[str, int]] = {}
    for r in d.groupBy(task, bucket).agg(F.count("*").alias("n")).collect():  # one row per task and bucket
        sizes.setdefault(r[task], {})[r[bucket]] = r.n
    quota = F.create_map(*[x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))])
    # in a bucket no source gives more than its first `cap` rows; and of the rows left, at most as many as the quota are
    # refused for the cap in each of the two passes, so three times the quota, in order, is all that can be looked at
    d = d.withColumn("_q", F.element_at(quota, F.col(task)))
    blank = F.coalesce(F.col(source), F.lit("")) == ""
    d = _firsts(d.where(~blank), [task, bucket, source], F.lit(cap)).unionByName(d.where(blank))
    d = _firsts(d, [task, bucket], F.col("_q") * 3)
    names = df.columns

    def choose(f):
        t = f[task].iloc[0]
        want = largest_remainder(sizes[t], min(quotas[t], sum(sizes[t].values())), sizes[t])
        taken, of_source = [], {}

        def passes(order, open_in=None):
            for i in order:
                if len(taken) == quotas[t]:
                    return
                b, src = f.at[i, bucket], f.at[i, source] or ""
                if i in seen or (open_in is not None and open_in.get(b, 0) <= 0) or (src and of_source.get(src, 0) >= cap):
                    continue
                taken.append(i)
                seen.add(i)
                of_source[src] = of_source.get(src, 0) + 1
                if open_in is not None:
                    open_in[b] -= 1

        seen: set = set()
        passes(f.sort_values([bucket, "_r"], kind="stable").index, dict(want))
        passes(f.sort_values("_r", kind="stable").index)
        return f.loc[taken, names]

    def run(table):
        import pyarrow as pa

        out = choose(table.to_pandas())
        return pa.Table.from_pandas(out, schema=pa.schema([table.schema.field(n) for n in names]), preserve_index=False)

    return d.groupBy(task).applyInArrow(run, df.schema)
