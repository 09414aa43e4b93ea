import math
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.llm import leaks, overlap


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, c in enumerate(a):
        q = [i + 1]
        for j, x in enumerate(b):
            q.append(min(p[j] + (c != x), p[j + 1] + 1, q[j] + 1))
        p = q
    return p[-1]


def noisy(rng, t, edits):
    s = list(t)
    for _ in range(edits):
        k = rng.randrange(3) if len(s) > 1 else 2
        i = rng.randrange(max(len(s), 1))
        if k == 0:
            s[i] = rng.choice("가나다라")
        elif k == 1:
            del s[i]
        else:
            s.insert(i, rng.choice("마바사"))
    return "".join(s)


def test_edit_within():
    rng = random.Random(1)
    pairs = [("".join(rng.choice("abc") for _ in range(rng.randrange(50))),) for _ in range(150)]
    a = [p[0] for p in pairs]
    b = [noisy(rng, x, rng.randrange(9)) if x else "a" for x in a]
    want = [distance(x, y) <= int(0.15 * max(len(x), len(y)) + 1e-9) for x, y in zip(a, b)]
    assert list(overlap.edit_within(a, b, 0.15)) == want


def test_row_pairs_against_all_pairs(spark):
    rng = random.Random(6)
    words = [w for w in "보증금 냉장고 필라테스 주차권 도시락 커튼 방석 기차표 머리끈 셔츠 구두 면접 연차 막차 택시 화분".split()]
    base = [" ".join(rng.choice(words) + rng.choice("을를은는이가") for _ in range(26)) for _ in range(40)]
    rows = []
    for i, t in enumerate(base):
        rows.append((i, f"[{i}-1] {t}", "train"))
        rows.append((1000 + i, noisy(rng, t, rng.randrange(1, 9)), "eval"))
    rows += [(2000, base[0].upper().replace(" ", "  "), "eval"), (2001, base[0], "train"), (2002, None, "eval"), (2003, base[1], None), (2004, "짧다", "eval"), (2005, base[2] * 60, "train"), (2006, base[2] * 60, "eval")]
    df = spark.createDataFrame(rows, "row_id long, output string, split string").withColumn("cid", F.lit(1)).withColumn("row", F.lit("x"))
    got = {tuple(r) for r in overlap.row_pairs(df, "row_id", "output", "split").collect()}
    import re

    sq = {i: ("".join(re.sub(r"^\s*\[\d+(-\d+)*\]", "", t).lower().split()), len(re.sub(r"^\s*\[\d+(-\d+)*\]", "", t).strip()), s) for i, t, s in rows if t and s}
    want = set()
    for i, (x, n, s) in sq.items():
        for j, (y, m, r) in sq.items():
            if i < j and s != r and min(n, m) >= 80 and abs(len(x) - len(y)) <= 0.15 * max(len(x), len(y)):
                if x == y or distance(x, y) <= 0.15 * max(len(x), len(y)):
                    want.add((i, j))
    assert got == want
    assert overlap.row_pairs(df.limit(0), "row_id", "output", "split").collect() == []


def test_short_bodies_meet_by_short_grams(spark):
    a = "가나다라마바사아자차카타파하 " * 1 + "거너더러머버서어저처커터퍼허"
    rows = [(1, a + " " * 0 + " . " * 30, "train"), (2, a.replace("마", "미") + " . " * 30, "eval")]
    df = spark.createDataFrame(rows, "row_id long, output string, split string")
    assert [tuple(r) for r in overlap.row_pairs(df, "row_id", "output", "split").collect()] == [(1, 2)]


def test_myers_against_table():
    rng = random.Random(2)

    def semi(p, t):
        prev = [0] * (len(t) + 1)
        for i, c in enumerate(p):
            cur = [i + 1]
            for j, x in enumerate(t):
                cur.append(min(prev[j] + (c != x), prev[j + 1] + 1, cur[j] + 1))
            prev = cur
        return min(prev)

    ps = [[rng.randint(1, 3) for _ in range(rng.randint(1, 64))] for _ in range(40)]
    ts = [[rng.randint(1, 3) for _ in range(rng.randint(0, 90))] for _ in range(40)]
    P, T = np.zeros((40, 64), np.uint32), np.zeros((40, 90), np.uint32)
    for i in range(40):
        P[i, : len(ps[i])], T[i, : len(ts[i])] = ps[i], ts[i]
    got = leaks.myers(P, np.array([len(p) for p in ps]), T, np.array([len(t) for t in ts]))
    assert got.tolist() == [semi(p, t) for p, t in zip(ps, ts)]


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    items = [(i, "".join(rng.choice("가나다라마바사 .,AB1") for _ in range(rng.randrange(20, 160)))) for i in range(25)] + [(90, None), (91, "")]
    docs = []
    for i in range(80):
        t = "".join(rng.choice("가나다라 마바사ab") for _ in range(200))
        k, src = rng.random(), rng.choice(items[:25])[1]
        if k < 0.7:
            a = rng.randrange(max(len(src) - 50, 1))
            t = t[:90] + src[a : a + rng.randrange(30, 120)].lower() + t[90:]
        docs.append((i, t))
    docs += [(200, None), (201, ""), (202, (items[0][1] + "zz") * 3000), (203, docs[0][1])]
    bare = lambda s: "".join(c for c in (s or "").lower() if c.isalnum())
    want = set()
    for d, t in docs:
        b = bare(t)
        have = {b[k : k + 40] for k in range(len(b) - 39)}
        for i, x in items:
            y = bare(x)
            if any(y[k : k + 40] in have for k in range(len(y) - 39)):
                want.add((d, i))
    dd = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("item", F.lit(1))
    ii = spark.createDataFrame(items, "item_id long, text string")
    for block, edits in ((20_000, 0), (20_000, 2), (7, 2)):
        got = {(r.key, r.item) for r in leaks.find(dd, "doc_id", "text", ii, "item_id", "text", edits=edits, block=block).where("distance = 0").collect()}
        assert got == want
    assert leaks.find(dd.limit(0), "doc_id", "text", ii, "item_id", "text").collect() == []
    assert leaks.find(dd, "doc_id", "text", ii.limit(0), "item_id", "text").collect() == []
    with pytest.raises(ValueError):
        leaks.find(dd, "doc_id", "text", ii, "item_id", "text", least=80)
    assert pa.__version__


def test_edited_passages_against_brute_force(spark):
    rng = random.Random(11)
    items = [(i, "".join(rng.choice("가나다라마바사아자차카타") for _ in range(rng.randrange(30, 90)))) for i in range(12)]
    docs = []
    for i in range(120):
        src = rng.choice(items)[1]
        a = rng.randrange(max(len(src) - 44, 1))
        docs.append((i, "".join(rng.choice("거너더러머") for _ in range(30)) + noisy(rng, src[a : a + rng.randrange(38, 60)], rng.randrange(6)) + "".join(rng.choice("거너더러머") for _ in range(30))))

    def least_edits(t, x):  # of any stretch of 40 characters of the item to any stretch of the document
        best = 99
        for k in range(len(x) - 39):
            prev = [0] * (len(t) + 1)
            for i, c in enumerate(x[k : k + 40]):
                cur = [i + 1]
                for j, y in enumerate(t):
                    cur.append(min(prev[j] + (c != y), prev[j + 1] + 1, cur[j] + 1))
                prev = cur
            best = min(best, *prev)
        return best

    want = {(d, i, e) for d, t in docs for i, x in items if len(x) >= 40 and set(t) & set(x) and sum(c in t for c in x) > 20 for e in [least_edits(t, x)] if e <= 2}
    dd, ii = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.key, r.item, r.distance) for r in leaks.find(dd, "doc_id", "text", ii, "item_id", "text").collect()}
    assert got == want and {e for _, _, e in got} == {0, 1, 2}


def test_pairs_with_the_most_edits_allowed(spark):
    rng = random.Random(9)
    rows = []
    for i, n in enumerate([64, 66, 70, 77, 80, 90, 120, 160, 200, 300] * 6):
        t = [chr(rng.randrange(0xAC00, 0xAC00 + 900)) for _ in range(n)]
        spread, edits = list(t), int(0.15 * n + 1e-9)
        for e in range(edits):  # no common stretch longer than six or so
            spread[min(n - 1, (e * n + n // 2) // edits)] = "힣"
        rows += [(i, " " * 20 + t[0] + " " * 20 + "".join(t[1:]), "train"), (1000 + i, spread[0] + " " * 40 + "".join(spread[1:]), "eval")]
        rows.append((2000 + i, noisy(rng, "".join(t), edits) + " " * 30 + "끝", "eval"))
    df = spark.createDataFrame(rows, "row_id long, output string, split string")
    sq = {i: "".join(t.split()) for i, t, _ in rows if len(t.strip()) >= 80}
    want = {(i, j) for i in sq if i < 1000 for j in (1000 + i, 2000 + i) if j in sq and distance(sq[i], sq[j]) <= int(0.15 * max(len(sq[i]), len(sq[j])) + 1e-9)}
    assert len(want) > 80
    assert {tuple(r) for r in overlap.row_pairs(df, "row_id", "output", "split").collect()} == want


def test_no_bound_drops_a_pair_within_the_budget():
    rng = random.Random(12)
    counts = np.ones(overlap.SLOTS, np.uint32)
    for _ in range(300):
        n = rng.choice([9, 30, 64, 70, 81, 130, 260, 600])
        a = "".join(rng.choice("가나다라마바사아자차카타파하") for _ in range(n))
        b = noisy(rng, a, int(0.15 * n))
        e = int(0.15 * max(len(a), len(b)) + 1e-9)
        if a == b or distance(a, b) > e:
            continue
        (p, x), (q, y) = (overlap.explode(pa.array([t]))[:2] for t in (a, b))
        assert overlap.alike((p, x), (q, y), 0.15).all()
        assert np.bitwise_count((overlap.signatures(p, x) ^ overlap.signatures(q, y)).view(np.uint64)).sum() <= 2 * e
        _, left, h, _ = overlap.all_grams(p, x, 0.15)
        _, right, nth, g, _ = overlap.picked_grams(q, y, 0.15, counts)
        d = left[:, None] - right
        ok = (h[:, None] == g) & (abs(d) <= nth) & (abs(d - len(a) + len(b)) <= e - nth)
        assert ok.any()


def test_boilerplate_is_cut_into_parts(spark):
    rng = random.Random(5)
    head = "안녕하세요 문의 주셔서 감사합니다 아래 내용을 확인하시고 다시 연락 부탁드립니다 감사합니다 그럼 좋은 하루 보내세요 "
    rows = [(i, head + "".join(rng.choice("가나다라마바사아자차") for _ in range(50)), "train" if i % 2 else "eval") for i in range(60)]
    rows += [(1000 + i, noisy(rng, rows[i][1], 6), "eval" if i % 2 else "train") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, output string, split string")
    some = [{tuple(r) for r in overlap.row_pairs(df, "row_id", "output", "split", hot=h).collect()} for h in (overlap.HOT, 7, 1)]
    assert some[0] == some[1] == some[2] and len(some[0]) >= 60


def _listed(left, right, per):
    """Batches as Spark hands them on: by term, the left side first."""
    rows = sorted([(t, -1, n, at, c, *sig) for t, n, at, c, sig in left] + [(t, j, n, at, c, *sig) for t, j, n, at, c, sig in right], key=lambda r: r[:2])
    names = ["term", "nth", "len", "at", "cid", "s0", "s1", "s2", "s3"]
    kinds = [pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 5]
    return [pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows[lo : lo + per]], k) for i, k in enumerate(kinds)], names=names) for lo in range(0, len(rows), per)]


def test_meetings_brute():
    rng = random.Random(4)
    sig = lambda: tuple(rng.choice([0, 7, (1 << 62) - 1, -1]) for _ in range(4))
    left, right = [], []
    for c in range(300):
        n = rng.randrange(80, 130)
        left.append((rng.randrange(-3, 3), n, rng.randrange(n - 4), c, sig()))
        n = rng.randrange(80, 130)
        right.append((rng.randrange(-3, 3), rng.randrange(15), n, rng.randrange(n - 4), c + 250, sig()))
    for share in (0.15, 0.4):
        want = set()
        for t, n, at, c, s in left:
            for u, j, m, to, d, r in right:
                k = math.floor(share * max(n, m) + 1e-9)
                bits = sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(s, r))
                if t == u and c != d and abs(at - to) <= j and abs(at - to - n + m) <= k - j and abs(n - m) <= k and bits <= 2 * k:
                    want.add((c, d))
        assert want
        for per, rows, step in ((1000, 200_000, 1 << 20), (7, 1, 5), (50, 60, 300)):
            got = [r for b in overlap.meetings(iter(_listed(left, right, per)), share, rows, step) for r in zip(*(x.to_pylist() for x in b.columns))]
            assert set(got) == want


def test_a_gram_of_many_texts_meets_by_place():
    """60,000 texts of each side under one gram at 60,000 places: 3.6 G pairs by gram, but few at the right places."""
    zero = (0, 0, 0, 0)
    n = 60_000
    batches = _listed([(1, 2 * n, i, i, zero) for i in range(n)], [(1, 1, 2 * n, i, n + i, zero) for i in range(n)], 10_000)
    began = time.monotonic()
    got = sum(b.num_rows for b in overlap.meetings(iter(batches), 0.15))
    assert got == 3 * n - 2 and time.monotonic() - began < 30
