"""Exact, canonical, set-based, signature-based and vector deduplication.

"First wins" is by an explicit order column. The greedy rule, by which a row falls for an earlier *kept* row,
is resolved in rounds: a row is kept once it is the earliest live row of every bucket it is in, and rows that
share a bucket with an earlier kept row fall. Rounds exchange one minimum per bucket, never pairs, so a bucket
with a third of all rows costs no more than its rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.codepoints import explode, grams
from ..session import Stage
from .counting import slot_counts

P61 = (1 << 61) - 1


def first_wins(df: DataFrame, keys: list[Column], order: str) -> DataFrame:
    """The first row of every key by the unique column ``order``; null is a key like others.

    The least ``order`` of each key is a hash aggregate over a digest of the key and a number, and the rows are kept
    by a semi-join on it: no row with its text goes through a sort or an aggregate. Where the rows are their keys and
    the order, that aggregate is all.
    """
    names = df.select(*keys).columns
    if {*names, order} == set(df.columns):
        return df.groupBy(*names).agg(F.min(order).alias(order)).select(df.columns)
    digest = F.sha2(F.to_json(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"}), 256)
    best = df.groupBy(digest.alias("k")).agg(F.min(order).alias(order)).select(order)
    return df.join(best, order, "left_semi")


def duplicate_rate(df: DataFrame, c: Column) -> DataFrame:
    n = df.agg(F.count("*").alias("rows"), F.count_distinct(F.sha2(c, 256)).alias("distinct_texts"))
    return n.withColumn("duplicate_rate", F.round((F.col("rows") - F.col("distinct_texts")) / F.col("rows"), 6))


def seeds(num: int = 128, seed: int = 42) -> tuple[list[int], list[int]]:
    """Multipliers and offsets of the permutations, from a 64-bit linear congruential generator."""
    x = seed & ((1 << 64) - 1)
    out = []
    for _ in range(2 * num):
        x = (x * 6364136223846793005 + 1442695040888963407) & ((1 << 64) - 1)
        out.append(x)
    return out[0::2], out[1::2]


def _mulmod(a: np.ndarray, b: int) -> np.ndarray:
    """a * b mod 2**61 - 1 for uint64 a below it, by halves of 32 and 29 bits."""
    b %= P61
    m = np.uint64(P61)
    bl, bh = np.uint64(b & 0xFFFFFFFF), np.uint64(b >> 32)
    al, ah = a & np.uint64(0xFFFFFFFF), a >> np.uint64(32)
    fold = lambda x: (x & m) + (x >> np.uint64(61))
    mid = fold(al * bh) + fold(ah * bl)  # times 2**32
    mid = fold(fold(mid))
    hi = mid >> np.uint64(29)  # 2**61 is 1
    lo = (mid & np.uint64((1 << 29) - 1)) << np.uint64(32)
    high = fold(ah * bh << np.uint64(3))  # times 2**64, that is 2**3
    return fold(fold(fold(al * bl) + fold(lo + hi) + high)) % m


def token_hash(t: str) -> int:
    return int.from_bytes(hashlib.blake2b(t.encode("utf-8"), digest_size=8).digest(), "big")


def signatures(t: pa.Array, num: int = 128, seed: int = 42, n: int = 5) -> pa.Array:
    """MinHash signatures over the character shingles of a column; blank texts have zeros, null stays null."""
    a, b = seeds(num, seed)
    texts, hashes, known = t.to_pylist(), [], {}
    count = np.zeros(len(texts), np.int64)
    for i, s in enumerate(texts):
        s = " ".join(s.split()).lower() if s else ""
        if s:
            sh = {s} if len(s) < n else {s[k : k + n] for k in range(len(s) - n + 1)}
            count[i] = len(sh)
            for q in sh:
                if q not in known:
                    known[q] = token_hash(q) % P61
                hashes.append(known[q])
    out = np.zeros((len(texts), num), np.int64)
    some = np.flatnonzero(count)
    if len(some):
        x = np.array(hashes, np.uint64)
        first = np.r_[0, np.cumsum(count[some])[:-1]]
        for k in range(num):  # one permutation over all shingles of the batch
            h = (_mulmod(x, a[k]) + np.uint64(b[k] % P61)) % np.uint64(P61)
            out[some, k] = np.minimum.reduceat(h, first).astype(np.int64)
    flat = pa.array(out.reshape(-1), pa.int64())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * num, pa.int32()), flat)
    return lists if all(s is not None for s in texts) else pa.array([None if s is None else r for s, r in zip(texts, out.tolist())], pa.list_(pa.int64()))


def signature(c: Column, num: int = 128, seed: int = 42, n: int = 5) -> Column:
    """MinHash signature over the character shingles of ``c``; blank texts have zeros, null stays null."""

    @F.arrow_udf("array<long>")
    def run(t: pa.Array) -> pa.Array:
        return signatures(t, num, seed, n)

    return run(c)


def buckets(df: DataFrame, order: str, sig: str, bands: int = 32) -> DataFrame:
    """``(ord, bucket)``, one row per band."""
    rows = 128 // bands
    band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.slice(F.col(sig), i * rows + 1, rows)))
    return df.where(F.col(sig).isNotNull()).select(F.col(order).alias("ord"), F.explode(band).alias("bucket"))


def greedy(members: DataFrame) -> DataFrame:
    """``members (ord, bucket)`` -> ``(ord, kept)`` by the greedy rule in order of ``ord``."""
    spark = members.sparkSession
    st = Stage(spark, "greedy")
    m = members.select("ord", "bucket").distinct()
    shared = m.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    everyone = m.select("ord").distinct()
    live = st.cut(m.join(shared, "bucket"))
    kept, fallen = None, None
    while not live.isEmpty():
        low = live.groupBy("bucket").agg(F.min("ord").alias("low"))
        flags = live.join(low, "bucket")
        sure = st.cut(flags.groupBy("ord").agg(F.min((F.col("ord") == F.col("low")).cast("int")).alias("first")).where("first = 1").select("ord"))
        taken = live.join(sure, "ord", "left_semi").select("bucket").distinct()
        down = st.cut(live.join(taken, "bucket", "left_semi").select("ord").distinct().join(sure, "ord", "left_anti"))
        kept = sure if kept is None else kept.unionByName(sure)
        fallen = down if fallen is None else fallen.unionByName(down)
        nxt = st.cut(live.join(sure, "ord", "left_anti").join(down, "ord", "left_anti"))
        st.drop(live)
        live = nxt
    if fallen is None:
        return everyone.withColumn("kept", F.lit(True))
    return everyone.join(fallen.withColumn("out", F.lit(True)), "ord", "left").select("ord", F.col("out").isNull().alias("kept"))


def minhash_kept(df: DataFrame, order: str, c: str, bands: int = 32) -> DataFrame:
    """``(ord, kept)`` for non-null texts: greedy MinHash deduplication, first row wins."""
    st = Stage(df.sparkSession, "minhash")
    sig = st.cut(df.where(F.col(c).isNotNull()).select(F.col(order).alias("ord"), signature(F.col(c)).alias("sig")))
    return greedy(buckets(sig, "ord", "sig", bands))


def minhash_clusters(df: DataFrame, order: str, c: str, bands: int = 32) -> DataFrame:
    """``(keeper, size)``: every kept row with the rows that fell for it and itself; a row falls for the earliest
    kept row it shares a band with."""
    st = Stage(df.sparkSession, "clusters")
    sig = st.cut(df.where(F.col(c).isNotNull()).select(F.col(order).alias("ord"), signature(F.col(c)).alias("sig")))
    band = st.cut(buckets(sig, "ord", "sig", bands))
    kept = st.cut(greedy(band))
    owner = band.join(kept.where("kept").select("ord"), "ord", "left_semi").groupBy("bucket").agg(F.min("ord").alias("keeper"))
    to = band.join(kept.where("not kept").select("ord"), "ord", "left_semi").join(owner, "bucket").groupBy("ord").agg(F.min("keeper").alias("keeper"))
    all_rows = to.select("keeper").unionByName(kept.where("kept").select(F.col("ord").alias("keeper")))
    return all_rows.groupBy("keeper").agg(F.count("*").alias("size"))


JACCARD_SLOTS = 1 << 20


def jaccard_pairs(df: DataFrame, key: str, group: str, c: str, n: int = 4, least: float = 0.85) -> DataFrame:
    """``(a, b, jaccard)`` of rows of one group whose n-gram sets (blanks removed) reach ``least``.

    Prefix filter: in one order of the grams, two sets that similar share a gram among the first (1 - least) * size
    + 1 of each, so only those are joined, not the group with itself. The order is by rarity: grams are counted in a
    table of fixed size, whatever the input, so the grams that boilerplate shares come last.
    """
    spark = df.sparkSession
    t = df.select(F.col(key).alias("k"), F.col(group).alias("grp"), F.regexp_replace(c, r"\s+", "").alias("t")).where(F.length("t") >= n)

    def add(b: pa.RecordBatch, acc: np.ndarray) -> None:
        cp, off, _ = explode(b.column(0))
        np.add.at(acc, (grams(cp, off, n)[2] % JACCARD_SLOTS).astype(np.int64), 1)

    shared = spark.sparkContext.broadcast(slot_counts(t.select("t"), JACCARD_SLOTS, add))

    def prefixes(batches):
        counts = shared.value
        for b in batches:
            cp, off, _ = explode(b.column(0))
            row, _, h = grams(cp, off, n)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            first = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])] if len(row) else np.zeros(0, bool)
            row, h = row[first], h[first]  # each gram of a row once
            order = np.lexsort((h, counts[(h % JACCARD_SLOTS).astype(np.int64)], row))
            row, h = row[order], h[order]
            size = np.bincount(row, minlength=b.num_rows)
            place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
            ok = place < size[row] - np.ceil(size[row] * least - 1e-9) + 1
            at = pa.array(row[ok])
            yield pa.RecordBatch.from_arrays([b.column(1).take(at), b.column(2).take(at), pa.array(h[ok].view(np.int64)), pa.array(size[row[ok]].astype(np.int32))], names=["k", "grp", "t", "n"])

    kinds = dict(t.dtypes)
    p = t.select("t", "k", "grp").mapInArrow(prefixes, f"k {kinds['k']}, grp {kinds['grp']}, t long, n int")
    q = p.select("grp", "t", F.col("k").alias("k2"), F.col("n").alias("n2"))
    cand = p.join(q, ["grp", "t"]).where((F.col("k") < F.col("k2")) & (F.least("n", "n2") >= F.greatest("n", "n2") * least)).select("k", "k2").distinct()
    sets = t.select("k", "t")  # texts go through the joins, their sets are made after
    ga, gb = (F.array_distinct(text.ngrams(F.col(x), n)) for x in ("ta", "tb"))
    both = cand.join(sets.toDF("k", "ta"), "k").join(sets.toDF("k2", "tb"), "k2").select("k", "k2", ga.alias("ga"), gb.alias("gb"))
    both = both.withColumn("common", F.size(F.array_intersect("ga", "gb"))).withColumn("jaccard", F.round(F.col("common") / (F.size("ga") + F.size("gb") - F.col("common")), 6))
    return both.where(F.col("jaccard") >= least).select(F.col("k").alias("a"), F.col("k2").alias("b"), "jaccard")


#: Rows and characters of a thread up to which one task holds all of it.
WHOLE_ROWS, WHOLE_CHARS = 1_000, 2_000_000


def _four_grams(cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, code)`` of every 4-gram within one row; codes are equal where the grams are, within this batch."""
    seen = np.zeros(0x110000, bool)
    seen[cp] = True
    ids = np.cumsum(seen)
    x = ids[cp].astype(np.uint64)
    pair = x[:-1] << np.uint64(32) | x[1:]
    pair = x[:-1] << np.uint64(16) | x[1:] if ids[-1] < 1 << 16 else np.unique(pair, return_inverse=True)[1].astype(np.uint64)
    many = np.maximum(np.diff(off) - 3, 0)
    row = np.repeat(np.arange(len(many)), many)
    at = np.arange(len(row)) - (np.cumsum(many) - many)[row] + off[row]
    return row, pair[at] << np.uint64(32) | pair[at + 2]


def _alike(group: np.ndarray, texts: pa.Array, least: float, step: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """``(early, late)``: rows of one group whose 4-gram sets reach ``least``; by the prefix filter of ``jaccard_pairs``."""
    none = np.zeros(0, np.int64)
    cp, off, _ = explode(texts)
    if len(cp) < 4:
        return none, none
    row, code = _four_grams(cp, off)
    n = len(texts)
    with np.errstate(over="ignore"):
        slot = ((code ^ group[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(42)).astype(np.int64)
    often = np.bincount(slot, minlength=1 << 22)[slot]
    order = np.lexsort((code, often, row))
    row, code, often = row[order], code[order], often[order]
    first = np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])][: len(row)]
    row, code, often = row[first], code[first], often[first]
    size = np.bincount(row, minlength=n)
    place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
    met = (place < size[row] - np.ceil(size[row] * least - 1e-9) + 1) & (often > 1)  # a gram that comes once meets nothing
    r, c = row[met], code[met]
    order = np.lexsort((r, c, group[r]))
    r, c = r[order], c[order]
    new = np.r_[True, (group[r[1:]] != group[r[:-1]]) | (c[1:] != c[:-1])][: len(r)]
    start = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    before = np.arange(len(r)) - start  # each row meets those before it in its run
    ends = np.cumsum(before)
    found = [none]
    lo = 0
    while lo < len(r):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + step, "right")))
        at = np.repeat(np.arange(lo, hi), before[lo:hi])
        nth = np.arange(len(at)) - np.repeat(np.cumsum(before[lo:hi]) - before[lo:hi], before[lo:hi])
        a, b = r[start[at] + nth], r[at]
        fits = np.minimum(size[a], size[b]) >= np.maximum(size[a], size[b]) * least - 1e-9
        found.append(np.unique(a[fits] * n + b[fits]))
        lo = hi
    found = np.unique(np.concatenate(found))
    a, b = found // n, found % n
    used = np.zeros(n, bool)
    used[a] = used[b] = True
    row, code = row[used[row]], code[used[row]]
    names, code = np.unique(code, return_inverse=True)
    keys = np.sort(row * len(names) + code)
    begin = np.searchsorted(keys, np.arange(n) * len(names))
    ok = np.zeros(len(a), bool)
    per = np.cumsum(size[a])
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(per, (per[lo - 1] if lo else 0) + step, "right")))
        many = size[a[lo:hi]]
        pair = np.repeat(np.arange(hi - lo), many)
        at = begin[a[lo:hi]][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        want = keys[at] % len(names) + b[lo:hi][pair] * len(names)
        hit = keys[np.minimum(np.searchsorted(keys, want), len(keys) - 1)] == want
        common = np.bincount(pair[hit], minlength=hi - lo)
        ok[lo:hi] = np.round(common / (many + size[b[lo:hi]] - common), 6) >= least
        lo = hi
    return a[ok], b[ok]


def _thread_kept(group: np.ndarray, texts: pa.Array, exempt: np.ndarray, least: float) -> np.ndarray:
    """Which rows stay; rows of a group stand together, in their order.

    Of equal texts the first decides for all that are not exempt; the first exempt one stays and claims what follows."""
    n = len(group)
    at = np.arange(n)
    kept = np.ones(n, bool)
    long = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False) >= 4
    text_no = pc.fill_null(texts.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    _, first, cls = np.unique(group * (n + 1) + text_no + 1, return_index=True, return_inverse=True)
    post = np.full(len(first), n)
    np.minimum.at(post, cls, np.where(exempt, at, n))
    rep = (at == first[cls]) | (at == post[cls])
    kept[long & ~rep & ~exempt] = False
    reps = np.flatnonzero(long & rep)
    a, b = _alike(group[reps], texts.take(pa.array(reps)), least)
    a, b = reps[a], reps[b]
    a, b = a[~exempt[b]], b[~exempt[b]]
    order = np.lexsort((a, b))
    stays = kept.tolist()
    for x, y in zip(a[order].tolist(), b[order].tolist()):  # what is before y is decided
        if stays[x]:
            stays[y] = False
    return np.array(stays, bool)


def _large_threads(rows: DataFrame, least: float) -> DataFrame:
    """``(k)`` of the rows ``(k, grp, t, exempt)`` that fall, for threads too large for one task: over the similar
    pairs in rounds; a row is decided once all earlier rows like it are."""
    st = Stage(rows.sparkSession, "thread_greedy")
    rows = st.cut(rows.where(F.length("t") >= 4))
    same = rows.groupBy("grp", "t").agg(F.min("k").alias("first"), F.min(F.when(F.col("exempt"), F.col("k"))).alias("post"))
    reps = same.select("grp", "t", F.explode(F.array_distinct(F.array("first", "post"))).alias("k")).where("k is not null")
    reps = st.cut(reps)
    may_fall = rows.where("not exempt").select("k")
    st.add(may_fall.join(reps, "k", "left_anti"), "fallen")
    links = jaccard_pairs(reps, "k", "grp", "t", 4, least).select(F.col("a").alias("early"), F.col("b").alias("late"))
    links = st.cut(links.join(may_fall.withColumnRenamed("k", "late"), "late", "left_semi"))
    while not links.isEmpty():
        # rows that wait for nobody are kept; what is like them falls, and with it its own claims
        free = links.select(F.col("early").alias("k")).distinct().join(links.select(F.col("late").alias("k")), "k", "left_anti")
        down = st.cut(links.join(free.withColumnRenamed("k", "early"), "early", "left_semi").select(F.col("late").alias("k")).distinct())
        st.add(down, "fallen")
        gone = down.select(F.col("k").alias("late"))
        left = st.cut(links.join(gone, "late", "left_anti").join(down.withColumnRenamed("k", "early"), "early", "left_anti").join(free.withColumnRenamed("k", "early"), "early", "left_anti"))
        st.drop(links, down)
        links = left
    return rows.sparkSession.read.schema(may_fall.schema).parquet(f"{st.root}/fallen")


def thread_greedy(df: DataFrame, key: str, thread: str, c: str, exempt: Column, least: float = 0.85, whole_rows: int = WHOLE_ROWS, whole_chars: int = WHOLE_CHARS) -> DataFrame:
    """``(key, kept)``: within a thread, in order of ``key``, a row falls for an earlier kept row whose 4-gram set is
    ``least`` alike; exempt rows (posts) never fall but others fall for them. Rows without a thread or text stay.

    A thread of up to ``whole_rows`` rows and ``whole_chars`` characters is resolved by one task, so that each text
    goes through one exchange and no gram through any; larger ones by pairs, in rounds."""
    rows = df.select(F.col(key).alias("k"), F.col(thread).alias("grp"), F.regexp_replace(c, r"\s+", "").alias("t"), F.coalesce(exempt, F.lit(False)).alias("exempt"))
    alone = rows.where("grp is null").select("k", F.lit(True).alias("kept"))
    rows = rows.where("grp is not null")
    large = rows.groupBy("grp").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars")).where((F.col("n") > whole_rows) | (F.col("chars") > whole_chars))
    large = Stage(df.sparkSession, "large_threads").cut(large.select("grp"))
    rest = None
    if not large.isEmpty():
        some = rows.join(large, "grp", "left_semi")
        fallen = _large_threads(some, least)
        rest = some.select("k").join(fallen.withColumn("out", F.lit(True)), "k", "left").select("k", F.col("out").isNull().alias("kept"))
        rows = rows.join(large, "grp", "left_anti")

    def pieces(batches):
        """Batches of whole threads, of about ``whole_chars`` characters, one thread at least."""
        held = None
        for b in batches:
            held = b if held is None else pa.concat_batches([held, b])
            if held.num_rows < 2:
                continue
            g = held.column("grp")
            heads = np.flatnonzero(np.r_[True, pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)])
            ends = np.r_[0, np.cumsum(pc.fill_null(pc.utf8_length(held.column("t")), 0).to_numpy(zero_copy_only=False))][heads]
            lo = 0
            while lo < len(heads) - 1:  # the last thread may go on in the next batch
                hi = min(max(lo + 1, int(np.searchsorted(ends, ends[lo] + whole_chars, "right")) - 1), len(heads) - 1)
                yield held.slice(heads[lo], heads[hi] - heads[lo])
                lo = hi
            held = held.slice(heads[-1])
        if held is not None:
            yield held

    def run(batches):
        for b in pieces(batches):
            g = b.column("grp")
            group = np.cumsum(np.r_[False, pc.not_equal(g[1:], g[:-1]).to_numpy(zero_copy_only=False)]).astype(np.int64)
            kept = _thread_kept(group, b.column("t"), b.column("exempt").to_numpy(zero_copy_only=False), least)
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(kept)], names=["k", "kept"])

    out = rows.repartition("grp").sortWithinPartitions("grp", "k").mapInArrow(run, f"k {dict(rows.dtypes)['k']}, kept boolean").unionByName(alone)
    return out if rest is None else out.unionByName(rest)


def cosine(a: str, b: str) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def cosine_pairs(df: DataFrame, key: str, vec: str, least: float, step: int = 20, block: int = 4096) -> DataFrame:
    """``(query, id, cosine)``: every row whose key is divisible by ``step`` against all rows, in blocks of queries.

    Queries go out ``block`` at a time; each batch of rows meets them in one matrix product.
    """
    spark = df.sparkSession
    q = df.where((F.col(key) % step == 0) & F.col(vec).isNotNull()).select(F.col(key).alias("k"), F.col(vec).alias("v"))
    blocks = max(1, -(-q.count() // block))
    out = None
    for at in range(blocks):  # about `block` queries each, by hash
        rows = q.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == at).collect()
        m = np.array([r.v for r in rows], np.float64) if rows else np.zeros((0, 1))
        m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        shared = spark.sparkContext.broadcast(([r.k for r in rows], m))

        def run(batches, shared=shared):
            names, m = shared.value
            for b in batches:
                v = b.column(1)
                if not len(v) or not len(names):
                    continue
                x = np.array(v.to_pylist(), np.float64)
                s = np.round((x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)) @ m.T, 6)
                i, j = np.nonzero(s >= least)
                keys = np.array(b.column(0).to_pylist())
                keep = keys[i] != np.array(names)[j]
                yield pa.RecordBatch.from_arrays([pa.array(np.array(names)[j][keep]), pa.array(keys[i][keep]), pa.array(s[i, j][keep])], names=["query", "id", "cosine"])

        one = df.where(F.col(vec).isNotNull()).select(F.col(key), F.col(vec)).mapInArrow(run, "query long, id long, cosine double")
        out = one if out is None else out.unionByName(one)
    return out
