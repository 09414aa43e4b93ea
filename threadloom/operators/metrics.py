"""Distribution metrics between two sides of a corpus, as long tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.codepoints import explode, gram_hashes


def gram_counts(df: DataFrame, side: Column, c: str, n: int) -> DataFrame:
    """``(side, g, k)``: character n-grams of the raw text, counted per side."""
    g = df.where(F.col(c).isNotNull()).select(side.alias("side"), F.explode(text.ngrams(F.col(c), n)).alias("g"))
    return g.groupBy("side", "g").agg(F.count("*").alias("k"))


def jsd(counts: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``jsd`` in bits of two sides of ``(side, g, k)``: one aggregation per gram, no join."""
    t = counts.where(F.col("side").isin(a, b)).groupBy("g").agg(F.sum(F.when(F.col("side") == a, F.col("k"))).alias("p"), F.sum(F.when(F.col("side") == b, F.col("k"))).alias("q"))
    tot = t.agg(F.sum("p").alias("tp"), F.sum("q").alias("tq"))  # of the same exchange
    t = t.join(F.broadcast(tot))  # one row
    p, q = F.coalesce("p", F.lit(0)) / F.col("tp"), F.coalesce("q", F.lit(0)) / F.col("tq")
    m = (p + q) / 2
    half = F.when(p > 0, p * F.log2(p / m)).otherwise(0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0)
    return t.agg(F.round(F.sum(half) / 2, 6).alias("jsd"))


def hist_kl(hist: DataFrame, bins: int, a: str, b: str, eps: float = 1e-12, both: bool = False) -> DataFrame:
    """KL(a || b) in nats over bins 0..bins-1 of ``(side, bin, k)``; with ``both`` ``eps`` is added on both sides
    and empty bins of ``a`` count, else only its filled bins do."""
    spark = hist.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    t = all_bins.join(hist, "bin", "left").groupBy("bin").agg(F.coalesce(F.sum(F.when(F.col("side") == a, F.col("k"))), F.lit(0)).alias("p"), F.coalesce(F.sum(F.when(F.col("side") == b, F.col("k"))), F.lit(0)).alias("q"))
    tot = t.agg(F.sum("p").alias("tp"), F.sum("q").alias("tq"))
    t = t.join(F.broadcast(tot))  # one row
    p, q = F.col("p") / F.col("tp"), F.col("q") / F.col("tq")
    term = (p + eps) * F.ln((p + eps) / (q + eps)) if both else F.when(p > 0, p * F.ln(p / (q + eps))).otherwise(0)
    return t.agg(F.round(F.sum(term), 6).alias("kl"))


def presence(df: DataFrame, side: Column, c: str, terms: list[str]) -> DataFrame:
    """``(side, term, ratio)``: the share of texts that hold each term; one pass, one column per term."""
    aggs = [F.avg(F.contains(F.col(c), F.lit(t)).cast("int")).alias(f"t{i}") for i, t in enumerate(terms)]
    wide = df.where(F.col(c).isNotNull()).groupBy(side.alias("side")).agg(*aggs)
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"t{i}").alias("ratio")) for i, t in enumerate(terms)]))
    return wide.select("side", pairs.alias("p")).select("side", "p.term", "p.ratio")


def wilson(hits: Column, n: Column, z: float = 1.959964) -> tuple[Column, Column]:
    p = hits / n
    d = 1 + z * z / n
    mid = (p + z * z / (2 * n)) / d
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return F.round(mid - half, 6), F.round(mid + half, 6)


def hist_kl_symmetric(hist: DataFrame, bins: int, a: str, b: str, eps: float) -> DataFrame:
    """One row ``kl``: the mean of the two directions, with ``eps`` on both sides."""
    t = hist.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(hist, "bin", "left").groupBy("bin")
    t = t.agg(*[F.coalesce(F.sum(F.when(F.col("side") == x, F.col("k"))), F.lit(0)).alias(c) for c, x in (("p", a), ("q", b))])
    t = t.join(F.broadcast(t.agg(F.sum("p").alias("tp"), F.sum("q").alias("tq"))))  # one row
    p, q = F.col("p") / F.col("tp") + eps, F.col("q") / F.col("tq") + eps
    return t.agg((F.sum((p - q) * F.ln(p / q)) / 2).alias("kl"))


def gate(values: DataFrame, thresholds: dict[str, tuple[str, float]], suspect: tuple[str, ...] = ("mauve_score",), too_good: float = 0.99) -> DataFrame:
    """``values (metric, value)`` against thresholds: ``(metric, value, op, threshold, violation)``. A missing value is
    a violation; so is one above ``too_good`` for the ``suspect`` metrics, where it hints at a leak."""
    spark = values.sparkSession
    t = spark.createDataFrame([(k, op, float(v)) for k, (op, v) in thresholds.items()], "metric string, op string, threshold double")
    ok = F.when(F.col("op") == "le", F.col("value") <= F.col("threshold")).otherwise(F.col("value") >= F.col("threshold"))
    why = F.when(F.col("value").isNull(), "value_unavailable").when(~ok, "out_of_bounds").when(F.col("metric").isin(*suspect) & (F.col("value") > too_good), "too_good")
    return t.join(values, "metric", "left").select("metric", "value", "op", "threshold", why.alias("violation"))


def term_fires(df: DataFrame, c: str, terms: list[str]) -> DataFrame:
    """``(term, fires, rows_with, rows)``: how often each term occurs without overlapping itself, in how many texts, and
    the rows of the table; one row per term, whatever the table holds.

    One pass for any number of terms: per length of terms, the n-grams of a batch go through a sieve, are looked up by
    hash and compared. Null texts hold nothing but count as rows; an empty term is an error.
    """
    if not all(terms):
        raise ValueError("empty term")
    names = sorted(set(terms))
    by: dict[int, list[int]] = {}
    for i, t in enumerate(names):
        by.setdefault(len(t), []).append(i)

    def run(batches):
        tables = []
        for n, which in by.items():
            cps = np.array([[ord(ch) for ch in names[i]] for i in which], np.uint32)
            h = np.array([gram_hashes(x, n)[0] for x in cps])
            order = np.argsort(h)
            sieve = np.zeros(1 << 16, bool)
            sieve[(h >> np.uint64(48)).astype(np.int64)] = True
            loops = np.array([any(names[i].startswith(names[i][k:]) for k in range(1, n)) for i in which])
            tables.append((n, h[order], np.array(which)[order], cps[order], loops[order], sieve))
        fires, rows, seen = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), 0
        for b in batches:
            cp, off, _ = explode(b.column(0))
            seen += b.num_rows
            for n, keys, which, cps, loops, sieve in tables:
                h = gram_hashes(cp, n)
                place = np.flatnonzero(sieve[(h >> np.uint64(48)).astype(np.int64)])
                term = np.minimum(np.searchsorted(keys, h[place]), len(keys) - 1)
                row = np.searchsorted(off, place, "right") - 1
                ok = (keys[term] == h[place]) & (place + n <= off[row + 1])
                place, row, term = place[ok], row[ok], term[ok]
                same = (cp[place[:, None] + np.arange(n)] == cps[term]).all(1)
                place, row, term = place[same], row[same], term[same]
                if loops[term].any():  # a term that may overlap itself counts from the left
                    keep, last = ~loops[term], {}
                    for k in np.flatnonzero(~keep):
                        key = (row[k], term[k])
                        if place[k] >= last.get(key, -1):
                            keep[k], last[key] = True, place[k] + n
                    place, row, term = place[keep], row[keep], term[keep]
                fires += np.bincount(which[term], minlength=len(names))
                pair = np.unique(row * len(names) + which[term])
                rows += np.bincount(pair % len(names), minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(fires), pa.array(rows), pa.array(np.full(len(names), seen))], names=["term", "fires", "rows_with", "rows"])

    none = df.sparkSession.createDataFrame([(t, 0, 0, 0) for t in names], "term string, fires long, rows_with long, rows long")
    got = df.select(c).mapInArrow(run, "term string, fires long, rows_with long, rows long").unionByName(none)
    return got.groupBy("term").agg(*[F.sum(k).alias(k) for k in ("fires", "rows_with", "rows")])


def ratio_match(df: DataFrame, side: Column, a: str, b: str, kind: str, c: str, patterns: dict[str, str]) -> DataFrame:
    """``(kind, worst)``: the largest difference between two sides in the share of texts with a pattern, per kind and
    over all (kind ``any``); a kind that only one side has is left out."""
    t = df.select(F.col(kind).alias("kind"), side.alias("side"), F.col(c).alias("c")).where("c is not null")
    share = lambda x, p: F.avg(F.when(F.col("side") == x, F.col("c").rlike(p).cast("int")))
    worst = F.greatest(*[F.abs(share(a, p) - share(b, p)) for p in patterns.values()])
    g = t.groupingSets([("kind",), ()], "kind").agg(F.round(worst, 6).alias("worst"), F.grouping("kind").alias("whole"))
    return g.where("worst is not null").select(F.when(F.col("whole") == 1, "any").otherwise(F.col("kind")).alias("kind"), "worst")
