"""Predicates, and cascades that name the first reason a row falls for."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import packs, text
from ..functions.codepoints import explode, grams


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, or null: one column gives both the kept rows and the counts."""
    out = F.lit(None).cast("string")
    for name, cond in reversed(rules):
        out = F.when(cond, name).otherwise(out)
    return out


def near_pattern(a: list[str], b: list[str], window: int = 60) -> str:
    """A pattern of a term of ``a`` and one of ``b`` that begin within ``window`` characters, without look-ahead, for
    lists none of whose terms begins inside a term of the other."""
    after = lambda x, y: "|".join(f"{t}.{{0,{window - len(t)}}}(?:{'|'.join(y)})" for t in x if len(t) <= window)
    return f"(?s)(?:{after(a, b)}|{after(b, a)})"


def proximity(c: Column, a: list[str], b: list[str], window: int = 60) -> Column:
    """Whether a term of ``a`` and one of ``b`` begin within ``window`` characters of each other. Null holds neither."""
    one, two = ("(?:" + "|".join(re.escape(t) for t in x) + ")" for x in (a, b))
    near = c.rlike(f"(?s)(?:(?={one}).{{0,{window}}}?{two}|(?={two}).{{0,{window}}}?{one})")
    return F.coalesce(text.any_term(c, a) & text.any_term(c, b) & near, F.lit(False))


def launch_reason(c: Column) -> Column:
    return first_reason([("blocked_deleted", c.rlike(packs.BLOCKED)), ("contact_or_url", c.rlike(packs.CONTACT)), ("promo_template", c.rlike(packs.PROMO))])


def is_promo(c: Column) -> Column:
    return c.rlike(r"01[016789][- .]?[0-9]{3,4}[- .]?[0-9]{4}") | c.rlike(r"https?://|open\.kakao") | (c.rlike(packs.PROMO_WORDS) & (F.length(c) > 60))


# A formal opening or closing of generated text.
FORMAL_GENERATED = r"(?i)안녕하세요|감사합니다\.|하겠습니다|도움이\s*되|말씀하신|문의\s*사항|참고하시기|좋은\s*하루|에\s*대해\s*알려"


def is_dense_promo(c: Column, share: float = 0.3) -> Column:
    """A contact, or advertising patterns that make up more matches per character than ``share``."""
    contact = c.rlike(r"01[016789][- .]?[0-9]{3,4}[- .]?[0-9]{4}") | c.rlike(r"https?://")
    return contact | (F.regexp_count(c, F.lit("(?i)(?:" + packs.AD + ")")) / F.greatest(F.length(c), F.lit(1)) > share)


def entropy(df: DataFrame, key: str, c: str, n: int = 5, least: int = 60) -> DataFrame:
    """``(key, entropy)``: Shannon entropy in bits of the character n-grams of texts of ``least`` characters or more.

    A document is one row, so its n-grams are counted where it stands, a batch at a time, without a shuffle.
    """
    t = df.select(F.col(key).alias("key"), F.trim(F.col(c)).alias("t")).where(F.length("t") >= least)

    def run(batches):
        for b in batches:
            cp, off, _ = explode(b.column(1))
            row, _, h = grams(cp, off, n)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            edge = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(row) else np.zeros(0, np.int64)
            k = np.diff(np.r_[edge, len(row)]).astype(float)
            total = np.bincount(row, minlength=b.num_rows)
            s = np.bincount(row[edge], k * np.log2(k), minlength=b.num_rows)
            bits = np.log2(np.maximum(total, 1)) - s / np.maximum(total, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bits)], names=["key", "entropy"])

    e = t.mapInArrow(run, f"key {dict(t.dtypes)['key']}, entropy double")
    return e.select("key", F.round("entropy", 6).alias("entropy"))


def entropy_reason(df: DataFrame, key: str, cells: list[str], threshold: float, n: int = 5, least: int = 60) -> DataFrame:
    """``(key, low)``: whether all cells of a row that are long enough lie below ``threshold``; rows without such a
    cell are not low. A threshold of 0 turns the gate off."""
    long = df.select(F.col(key).alias("key"), F.explode(F.array(*cells)).alias("t"))
    e = entropy(long, "key", "t", n, least).groupBy("key").agg(F.max("entropy").alias("most"))
    return df.select(F.col(key).alias("key")).join(e, "key", "left").select("key", F.coalesce(F.col("most") < threshold, F.lit(False)).alias("low"))


def frequent_copies(df: DataFrame, c: Column, least: int = 3) -> DataFrame:
    """Adds ``copies`` of the canonical key; with ``copies >= least`` every copy is to be dropped, the first too.

    Counts are aggregated, by a digest of the key, before they are joined back, so a key with a third of all rows is no
    window of its own. Rows with a null key are left out.
    """
    keyed = df.withColumn("_h", F.sha2(c, 256))
    n = keyed.groupBy("_h").agg(F.count("*").alias("copies"))
    return keyed.join(n, "_h").drop("_h")


def bursts(df: DataFrame, who: str, ts: str, least: int = 10, seconds: int = 3600) -> DataFrame:
    """Rows of ``who`` that stand in a window of ``seconds`` up to them with at least ``least`` rows.

    A row is counted in its own slice of ``seconds`` and shown to the next one, so a task sees two slices of one
    ``who`` at most, however many rows that one has in all.
    """
    t = F.col(ts).cast("timestamp").cast("double")
    d = df.withColumn("_t", t).withColumn("_slice", F.explode(F.array(F.floor(t / seconds), F.floor(t / seconds) + 1)))
    w = Window.partitionBy(who, "_slice").orderBy("_t").rangeBetween(-seconds, 0)
    own = F.floor(F.col("_t") / seconds) == F.col("_slice")
    return d.withColumn("in_window", F.count("*").over(w)).where(own & (F.col("in_window") >= least)).drop("_t", "_slice")
