"""Text that looks the same, brought to one form.

A batch of texts becomes one array of code points. Lookup tables give each code point its expansion
(nothing for invisible characters, one space for every kind of space, the plain letter for full-width,
half-width and look-alike letters, base and marks for composed letters); gathers and offsets lay the
expansions out; marks and jamo are then composed again on the whole array. No call is made per row.

What is kept apart: case, line breaks, the number of spaces, digits against letters, accents, ligatures,
superscripts and other compatibility forms with a look of their own.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codepoints import explode, implode, reoffset, rows_of
from ..session import Stage

# Letters of other scripts that are drawn like Latin ones, as strings of equal length.
LOOKALIKE_FROM = (
    "АВЕЅІЈКМНОРСТХУѴԌԚԜаеѕіјорсхуѵԛԝһԁҮҺӀ"  # Cyrillic
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονιρϲϳϹͿκυχ"  # Greek
    "ՕՍհոսօցզԼ"  # Armenian
    "ɑɡıȷꓐꓑꓒꓓꓖꓗꓙꓚꓜꓝꓠꓢꓣꓤꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ"  # Latin extensions and Lisu
)
LOOKALIKE_TO = (
    "ABESIJKMHOPCTXYVGQWaesijopcxyvqwhdYhI"
    "ABEZHIKMNOPTYXaovipcjCJkux"
    "OUhnuogqL"
    "agijBPdDGKJCZFNSRRVHWXYAEIOU"
)
# Characters that show as nothing, and blanks outside the space category.
INVISIBLE = [0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180E, 0x180F, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0x2061, 0x2062, 0x2063, 0x2064, 0x206A, 0x206B, 0x206C, 0x206D, 0x206E, 0x206F, 0xFEFF]
INVISIBLE_RANGES = [(0x00, 0x08), (0x0E, 0x1F), (0x7F, 0x84), (0x86, 0x9F), (0x202A, 0x202E), (0x2066, 0x2069), (0xFE00, 0xFE0F), (0xE0000, 0xE0FFF)]
BLANK = [0x09, 0x2800, 0x3164, 0xFFA0]

L0, V0, T0, S0 = 0x1100, 0x1161, 0x11A7, 0xAC00
SIZE = 0x110000


class Tables:
    """Everything is derived from the Unicode data of the running Python and the fixed values above."""

    def __init__(self):
        first = np.arange(SIZE, dtype=np.uint32)  # the single replacement, if there is just one
        count = np.ones(SIZE, np.uint8)
        many: dict[int, list[int]] = {}

        assert len(LOOKALIKE_FROM) == len(LOOKALIKE_TO), (len(LOOKALIKE_FROM), len(LOOKALIKE_TO))
        alike = {ord(a): ord(b) for a, b in zip(LOOKALIKE_FROM, LOOKALIKE_TO)}
        compat_of = {}  # conjoining jamo -> the letter shown alone
        for c in range(0x3131, 0x318F):
            d = unicodedata.decomposition(chr(c)).split()
            if len(d) == 2 and d[0] == "<compat>":
                compat_of[int(d[1], 16)] = c

        def expand(c: int) -> list[int]:
            if c in alike:
                return [alike[c]]
            d = unicodedata.decomposition(chr(c)).split()
            if not d or 0xAC00 <= c <= 0xD7A3 or 0x3131 <= c <= 0x318E:
                return [c]
            if d[0] in ("<wide>", "<narrow>"):
                d = d[1:]
            elif d[0].startswith("<"):
                return [c]
            return [y for x in d for y in expand(int(x, 16))]

        for c in range(0x80, SIZE):
            if 0xD800 <= c <= 0xDFFF or 0x3400 <= c < 0x9FFF or 0x20000 <= c < 0x2F800:
                continue
            e = expand(c)
            if e != [c]:
                first[c] = e[0]
                if len(e) > 1:
                    count[c] = len(e)
                    many[c] = e
        for c in range(0x80, 0x3100):
            if unicodedata.category(chr(c)) == "Zs":
                first[c], count[c] = 0x20, 1
                many.pop(c, None)
        for c in BLANK:
            first[c] = 0x20
        for c in INVISIBLE + [x for a, b in INVISIBLE_RANGES for x in range(a, b + 1)]:
            count[c] = 0
        first[0x85] = first[0x2028] = first[0x2029] = 0x0A

        # expansions of more than one code point lie one after another in `pool`
        start = np.zeros(SIZE, np.uint32)
        pool: list[int] = []
        for c, e in many.items():
            start[c] = len(pool)
            pool += e
        self.first, self.count, self.start, self.pool = first, count, start, np.array(pool or [0], np.uint32)
        # syllables go through jamo, so that any coding of them ends in the same place
        self.ccc = np.zeros(SIZE, np.uint8)
        pairs = {}
        for c in range(0x80, SIZE):
            if 0xD800 <= c <= 0xDFFF or 0x3400 <= c < 0x9FFF or 0xAC00 <= c <= 0xD7A3 or c >= 0x20000:
                continue
            k = unicodedata.combining(chr(c))
            if k:
                self.ccc[c] = k
            d = unicodedata.decomposition(chr(c)).split()
            if len(d) == 2 and not d[0].startswith("<") and unicodedata.normalize("NFC", chr(c)) == chr(c):
                pairs[(int(d[0], 16) << 21) | int(d[1], 16)] = c
        keys = np.array(sorted(pairs), np.int64)
        self.pair_key, self.pair_to = keys, np.array([pairs[k] for k in keys], np.uint32)
        self.alone = np.arange(0x1200, dtype=np.uint32)
        for j, c in compat_of.items():
            if j < 0x1200:
                self.alone[j] = c
        for c in range(0x11A8, 0x11C3):  # final consonants alone show as the letter, too
            name = unicodedata.name(chr(c)).replace("HANGUL JONGSEONG ", "HANGUL LETTER ")
            try:
                self.alone[c] = ord(unicodedata.lookup(name))
            except KeyError:
                pass


@functools.cache
def tables() -> Tables:
    return Tables()


def unify(cp: np.ndarray, offsets: np.ndarray, sources: bool = False) -> tuple[np.ndarray, ...]:
    """``(code points, offsets)`` in the one form; with ``sources`` also the place each one came from."""
    t = tables()
    row = rows_of(offsets)
    # expansion
    n = t.count[cp]
    out = np.repeat(t.first[cp], n)
    if (n > 1).any():
        lead = np.cumsum(n.astype(np.int64)) - n
        rank = np.arange(len(out)) - np.repeat(lead, n)
        orig = np.repeat(cp, n)
        m = np.repeat(n, n) > 1
        out[m] = t.pool[t.start[orig[m]] + rank[m]]
    row = np.repeat(row, n)
    src = np.repeat(np.arange(len(cp)), n)
    rows = len(offsets) - 1

    # canonical order of marks: a stable sort of each run of marks by class
    k = t.ccc[out]
    if k.any():
        base = np.cumsum((k == 0) | np.r_[True, row[1:] != row[:-1]][: len(out)])
        order = np.lexsort((k, base))
        out, k = out[order], k[order]  # marks stay behind their base, so ``src`` keeps its order
        # Marks join their base one at a time, first come first, unless a mark of the same class stands between.
        while len(out):
            i = np.arange(len(out))
            first = np.r_[True, row[1:] != row[:-1]]
            base = np.maximum.accumulate(np.where((k == 0) | first, i, 0))
            before = np.r_[0, k[:-1]]
            at = np.flatnonzero((k > 0) & (base < i) & (k[base] == 0) & ((base == i - 1) | (before < k)))
            if not len(at):
                break
            key = (out[base[at]].astype(np.int64) << 21) | out[at].astype(np.int64)
            pos = np.minimum(np.searchsorted(t.pair_key, key), len(t.pair_key) - 1)
            hit = t.pair_key[pos] == key
            at, pos = at[hit], pos[hit]
            if not len(at):
                break
            lead, which = np.unique(base[at], return_index=True)
            out[lead] = t.pair_to[pos[which]]
            keep = np.ones(len(out), bool)
            keep[at[which]] = False
            out, row, k, src = out[keep], row[keep], k[keep], src[keep]

    # kana and other pairs whose second part is no mark of a class are composed by NFC as well, jamo below
    jamo = (out >= L0) & (out < 0x1200)
    if jamo.any():
        same = np.r_[False, row[1:] == row[:-1]][: len(out)]
        lead = (out >= L0) & (out < L0 + 19)
        vow = (out >= V0) & (out < V0 + 21)
        at = np.flatnonzero(vow & same & np.r_[False, lead[:-1]][: len(out)])
        keep = np.ones(len(out), bool)
        out[at - 1] = S0 + ((out[at - 1] - L0) * 21 + (out[at] - V0)) * 28
        keep[at] = False
        out, row, src = out[keep], row[keep], src[keep]
        same = np.r_[False, row[1:] == row[:-1]][: len(out)]
        open_ = (out >= S0) & (out < S0 + 11172) & ((out - S0) % 28 == 0)
        tail = (out > T0) & (out < T0 + 28)
        at = np.flatnonzero(tail & same & np.r_[False, open_[:-1]][: len(out)])
        keep = np.ones(len(out), bool)
        out[at - 1] += out[at] - T0
        keep[at] = False
        out, row, src = out[keep], row[keep], src[keep]
        left = (out >= L0) & (out < 0x1200)
        out[left] = t.alone[out[left]]
    new = reoffset(np.bincount(row, minlength=rows))
    return (out, new, src) if sources else (out, new)


def unify_array(texts: pa.Array) -> pa.Array:
    cp, off, valid = explode(texts)
    out, new = unify(cp, off)
    return implode(out, new, valid)


def unified(text: Column) -> Column:
    """``text`` in its one form. Null stays null; a text of invisible characters becomes empty."""

    @F.arrow_udf("string")
    def form(t: pa.Array) -> pa.Array:
        return unify_array(t)

    return form(text)


_FORM, _SPELLING = ["f1", "f2"], ["s1", "s2"]


def _digested(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(k, f1, f2, s1, s2)``: every distinct key and text with 128 bits for its form and 128 for its spelling, written
    once: texts are read and unified once and go through no shuffle."""
    two = lambda c, names: [F.xxhash64(c).alias(names[0]), F.xxhash64(F.lit(1), c).alias(names[1])]
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("s")).where("k is not null and s is not null").withColumn("form", unified(F.col("s")))
    return Stage(df.sparkSession, "looks").cut(rows.select("k", *two(F.col("form"), _FORM), *two(F.col("s"), _SPELLING)).distinct())


def looks(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, look, spellings, links)``: one row per distinct key and text: a number of its look, how many different
    strings look so, and how many rows look the same but are different strings. Nothing is paired.

    Texts and forms are told apart by 128-bit hashes. Null texts and keys are left out, repeated rows count once. An
    empty table gives no rows.
    """
    rows = _digested(df, key, text)
    spelled = rows.groupBy(*_FORM, *_SPELLING).agg(F.count("*").alias("n"))
    shown = spelled.groupBy(*_FORM).agg(F.count("*").alias("spellings"), F.sum("n").alias("all"))
    each = spelled.join(shown, _FORM).select(*_FORM, *_SPELLING, "spellings", (F.col("all") - F.col("n")).alias("links"))
    return rows.join(each, [*_FORM, *_SPELLING]).select(F.col("k").alias("key"), F.col("f1").alias("look"), "spellings", "links")


def same_look(df: DataFrame, key: str, text: str, part: int = 1000) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of keys whose texts look the same but are different strings.

    Only forms with more than one spelling go on, spellings are paired, and keys come back by spelling, so exact
    copies are not paired with each other. The pairs of a form with many spellings are spread: its left spellings go
    to one of as many parts as it has times ``part`` spellings, its right ones to all. Texts and forms are told apart by
    128-bit hashes. Null texts and null keys pair with nothing; repeated rows of a key count once; texts without
    anything visible look the same as each other.
    """
    rows = _digested(df, key, text)
    spelled = rows.select(*_FORM, *_SPELLING).distinct()
    several = spelled.groupBy(*_FORM).agg(F.count("*").alias("n")).where("n > 1").select(*_FORM, F.ceil(F.col("n") / part).cast("int").alias("parts"))
    spelled = spelled.join(several, _FORM)
    left = spelled.select(*_FORM, F.pmod("s1", F.col("parts")).cast("int").alias("part"), *_SPELLING)
    right = spelled.select(*_FORM, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("s1").alias("t1"), F.col("s2").alias("t2"))
    pairs = left.join(right, [*_FORM, "part"]).where(F.struct("s1", "s2") < F.struct("t1", "t2")).drop("part")
    some = rows.join(several.select(*_FORM), _FORM, "left_semi")
    out = pairs.join(some.withColumnRenamed("k", "k1"), [*_FORM, *_SPELLING])
    out = out.join(some.select(*_FORM, F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.col("k").alias("k2")), [*_FORM, "t1", "t2"])
    return out.where("k1 <> k2").select(F.least("k1", "k2").alias("a"), F.greatest("k1", "k2").alias("b")).distinct()
