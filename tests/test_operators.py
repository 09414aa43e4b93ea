import math
import random
import re

import pytest
from pyspark.sql import functions as F

from threadloom.functions import packs, scrub, text
from threadloom.operators import dedup, examples, filters, metrics, quantiles, rules, sampling


def one(spark, col, *vals):
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    return [r[0] for r in df.select(col(F.col("t")).alias("x")).collect()]


def test_lengths_and_tokens(spark):
    n = lambda k: "x" * k
    assert one(spark, text.bin14, *map(n, (0, 10, 11, 60, 2200, 2201))) == [0, 1, 2, 4, 12, 13]
    assert one(spark, text.bucket_a, n(19), n(20), n(500)) == ["xs", "sm", "xxl"]
    assert one(spark, text.approx_tokens, *map(n, (0, 1, 11, 100))) == [1, 1, 5, 45]
    assert one(spark, text.excerpt, n(300))[0] == n(256) + "..."


def test_hashes_and_depth(spark):
    keys = ["t1", "t2", "t3", "t4"]
    assert one(spark, lambda c: text.hash64_mod(F.concat(c, F.lit(":42")), 2), *keys) == [0, 0, 0, 1]
    assert one(spark, lambda c: text.hash64_mod(F.concat(c, F.lit(":42")), 1000), *keys) == [406, 470, 818, 869]
    assert one(spark, text.md5_mod_10000, *keys) == [3991, 4722, 7801, 3946]
    assert one(spark, lambda c: text.reply_parts(c)["segments"], "[3] x", "[3-2] x", "[1-2-3] x", "x") == [1, 2, 3, 0]
    assert one(spark, lambda c: text.reply_parts(c)["index"], "[3] x", "[3-2] x") == [1, 3]


def test_jamo_and_rrn(spark):
    assert one(spark, text.nfkc, "ＡＢ ㅋㅋ ㄳ", None) == ["AB ㅋㅋ ㄳ", None]
    body, w = "900101-123456", (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5)
    s = sum(int(d) * k for d, k in zip(body.replace("-", ""), w))
    good = body + str((11 - s % 11) % 10)
    assert one(spark, text.rrn_valid, good, body + str((int(good[-1]) + 1) % 10), "1") == [True, False, False]


def test_scrub_order(spark):
    df = spark.createDataFrame([("a@b.com 010-1234-5678 123-45-67890 국민 123-45-6789 https://x.y/z",)], "t string")
    t, n = scrub.scrub(F.col("t"))
    r = df.select(t.alias("m"), *[c.alias(k) for k, c in n.items()]).first()
    assert r.m == "[이메일] [전화번호] [사업자번호] 국민 [계좌] [URL]" and (r.email, r.phone, r.business, r.account, r.url) == (1, 1, 1, 1, 1)


def test_entropy_and_proximity(spark):
    df = spark.createDataFrame([(1, "call now abc " * 5)], "k long, t string")
    assert filters.entropy(df, "k", "t").first().entropy == pytest.approx(3.692272, abs=1e-6)
    df = spark.createDataFrame([(1, "abc" * 6)], "k long, t string")
    assert filters.entropy(df, "k", "t", least=10).first().entropy == pytest.approx(1.577406, abs=1e-6)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abxy ") for _ in range(40)) for _ in range(60)] + [None, ""]

    def brute(t, w):
        a = [m.start() for m in re.finditer("(?=ab)", t or "")]
        b = [m.start() for m in re.finditer("(?=xy)", t or "")]
        return any(abs(i - j) <= w for i in a for j in b)

    assert one(spark, lambda c: filters.proximity(c, ["ab"], ["xy"], 3), *texts) == [brute(t, 3) for t in texts]


def test_dup3(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "t string")
    assert sorted(r.t for r in filters.frequent_copies(df, F.col("t")).where("copies < 3").collect()) == ["b", "b"]


def test_signature_against_big_integers(spark):
    a, b = dedup.seeds()
    assert (a[0], b[0], a[1], b[1]) == (10481999410520546993, 4159066171780167020, 7615522811268512075, 11628791489956661374)
    assert dedup.token_hash("hello") == 12085107955937391741
    docs = ["hello", "The quick  brown fox", "", None, "가나다라마바사"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "i long, t string")
    got = {r.i: r.s for r in df.select("i", dedup.signature(F.col("t")).alias("s")).collect()}

    def ref(t):
        t = " ".join(t.split()).lower()
        sh = {t} if len(t) < 5 else {t[i : i + 5] for i in range(len(t) - 4)}
        return [min((x * dedup.token_hash(q) + y) % dedup.P61 for q in sh) for x, y in zip(a, b)]

    assert got[0] == ref(docs[0]) and got[0][0] == 191125107626835980
    assert got[1] == ref(docs[1]) and got[4] == ref(docs[4]) and got[2] == [0] * 128 and got[3] is None


def test_greedy_equals_sequential(spark):
    assert {r.ord: r.kept for r in dedup.greedy(spark.createDataFrame([(1, 10), (2, 10), (2, 20), (3, 20)], "ord long, bucket long")).collect()} == {1: True, 2: False, 3: True}
    rng = random.Random(3)
    m = [(o, rng.randrange(25)) for o in range(40) for _ in range(3)]
    owner, kept = {}, {}
    for o in range(40):
        bs = {b for q, b in m if q == o}
        kept[o] = not any(b in owner for b in bs)
        if kept[o]:
            owner |= dict.fromkeys(bs, o)
    assert {r.ord: r.kept for r in dedup.greedy(spark.createDataFrame(m, "ord long, bucket long")).collect()} == kept


def test_jaccard_pairs_brute(spark):
    rng = random.Random(5)
    base = ["the red fox ran home today", "a quiet night at the old harbour", "무인카페에서 후배가 노트북을 문의했어요"]
    rows = []
    for i in range(40):
        t = list(rng.choice(base))
        if rng.random() < 0.6:
            t[rng.randrange(len(t))] = rng.choice("xyz!")
        rows.append((i, "g", "".join(t)))
    rows += [(100, "g", "abc"), (101, "g", "abc"), (102, "g", None)]
    df = spark.createDataFrame(rows, "i long, g string, t string")

    def grams(t):
        t = "".join((t or "").split())
        return {t[k : k + 4] for k in range(len(t) - 3)}

    want = {(a, b) for a, _, x in rows for b, _, y in rows if a < b and grams(x) and grams(y) and len(grams(x) & grams(y)) / len(grams(x) | grams(y)) >= 0.85}
    assert {(r.a, r.b) for r in dedup.jaccard_pairs(df, "i", "g", "t").collect()} == want


def test_jsd_and_kl(spark):
    def js(x, y):
        df = spark.createDataFrame([("a", x), ("b", y)], "s string, t string")
        return metrics.jsd(metrics.gram_counts(df, F.col("s"), "t", 2), "a", "b").first().jsd

    assert js("abab", "abba") == pytest.approx(0.207519, abs=1e-6)
    assert js("abab", "abab") == 0 and js("aa", "bb") == 1
    h = spark.createDataFrame([("a", 0, 3), ("a", 1, 1), ("b", 0, 1), ("b", 1, 1)], "side string, bin int, k long")
    assert metrics.hist_kl(h, 3, "a", "b").first().kl == pytest.approx(0.75 * math.log(1.5) + 0.25 * math.log(0.5), abs=1e-6)


def test_wilson_and_gate(spark):
    df = spark.createDataFrame([(80, 200), (70, 200), (110, 200)], "k long, n long")
    lo, hi = metrics.wilson(F.col("k"), F.col("n"))
    got = [(round(a, 4), round(b, 4)) for a, b in df.select(lo, hi).collect()]
    assert got == [(0.3346, 0.4692), (0.2873, 0.4184), (0.4808, 0.6174)]
    v = spark.createDataFrame([("bigram_jsd", 0.01)], "metric string, value double")
    g = {r.metric: r.violation for r in metrics.gate(v, packs.GATE).collect()}
    assert g["bigram_jsd"] is None and g["mauve_score"] == "value_unavailable" and len(g) == 7
    v = spark.createDataFrame([("bigram_jsd", 0.2), ("mauve_score", 0.995)], "metric string, value double")
    g = {r.metric: r.violation for r in metrics.gate(v, packs.GATE).collect()}
    assert g["bigram_jsd"] == "out_of_bounds" and g["mauve_score"] == "too_good"


def test_percentiles(spark):
    df = spark.range(1, 11)
    get = lambda m: tuple(quantiles.percentiles(df, F.col("id"), [0.5, 0.9], m).first())
    assert get("floor") == (6, 10) and get("nearest") == (5, 9) and get("round") == (5, 9)


def test_sampling(spark):
    assert sampling.largest_remainder({"a": 5, "b": 3, "c": 2}, 5) == {"a": 3, "b": 1, "c": 1}
    assert sum(sampling.largest_remainder({"a": 7, "b": 7, "c": 7}, 10).values()) == 10
    assert sampling.largest_remainder({}, 3) == {}
    w = [1.0] * 70 + [1.5] * 15 + [2.0] * 10 + [2.5] * 5
    df = spark.createDataFrame([(i, x) for i, x in enumerate(w * 20)], "i long, w double")
    n = {r.w: r.n / 20 for r in sampling.oversample(df, F.col("w"), F.col("i").cast("string")).groupBy("w").agg(F.count("*").alias("n")).collect()}
    assert n[1.0] == 70 and n[2.0] == 20 and abs(n[1.5] - 22.5) < 3 and abs(n[2.5] - 12.5) < 3
    bad = spark.createDataFrame([(1, float("nan")), (2, None), (3, 99.0)], "i long, w double")
    assert [r.c for r in bad.select(sampling.copies(F.col("w"), F.col("i").cast("string")).alias("c")).collect()] == [1, 1, 10]
    rn = sampling.row_numbers(spark.createDataFrame([(x,) for x in random.Random(2).sample(range(1000), 300)], "k long"), "k").collect()
    assert [r.rn for r in sorted(rn, key=lambda r: r.k)] == list(range(1, 301))


def test_examples(spark):
    df = spark.createDataFrame([([1, 2], [3, 4, 5]), ([1, 2, 3, 4], [9])], "p array<int>, a array<int>")
    r = df.select(*[c.alias(k) for k, c in examples.masked_example(F.col("p"), F.col("a"), 4).items()]).collect()
    assert r[0].labels == [-100, -100, 3, 4] and r[0].input_ids == [1, 2, 3, 4] and r[0].trainable and not r[1].trainable


def test_rules():
    s = rules.step({"bigram_jsd": 0.2}, rules.State())
    assert s.recipe == {"CPT_NUM_EPOCHS": 2} and s.stop is None and s.cycle == 1
    fired = []
    s = rules.State()
    for k in range(8):
        s = rules.step({"bigram_jsd": 0.2 + 0.02 * k}, s, cycles=99)
        fired.append(s.history[-1]["rule"] if s.stop is None else s.stop)
    assert fired == ["R1", "R1b", "R1c", "R7", "R7_FOLLOWUP", "R7_EXHAUSTED", "R7_EXHAUSTED", "R7_EXHAUSTED"]
    near = {"bigram_jsd": 0.14, "length_kl": 0.095, "digit_density_delta": 0.029}
    first = lambda m, **st: rules.first_match(m, rules.State(**st)).name
    assert first(near) == "R5" and first({}) == "R6" and first({}, recipe={"LORA_R": 128}) == "NO_RULE"
    assert first({"length_kl": 0.2}) == "R2" and first({"length_kl": 0.2}, data={"OVERSAMPLE_LG_XXL": 3}) == "R2b" and first({"english_density_delta": 0.03}) == "R3"
    assert first({"mauve_score": 0.5}) == "R4" and first({"mauve_score": 0.5}, recipe={"CPT_USE_DORA": 1}) == "R4b"
    past = tuple({"rule": "x", "metrics": {"bigram_jsd": j}, "recipe": {}, "data": {}} for j in (0.100, 0.102))
    assert first({}, history=past) == "R8" and rules.step({}, rules.State(history=past)).stop == "stagnation"  # it stops before that rule
    assert rules.step({"bigram_jsd": 0.01}, rules.State(), passed=True).stop == "converged"
    assert rules.step({}, rules.State(spent=25.0)).stop == "budget" and rules.step({}, rules.State(cycle=5)).stop == "cycles"
    second = lambda m, **r: rules.first_match(m, rules.State(recipe=r), rules.RULES_V2).name
    assert [second(m) for m in ({"domain_keyword_alignment": 0.3}, {"reply_depth_kl": 0.3}, {"persona_consistency": 0.5}, {"punct_ratio_match": 0.3}, {"initial_marker_match": 0.3}, {})] == ["R7", "R8", "R9", "R10", "R11", "R7-R11_NOOP"]
    assert second({"reply_depth_kl": 0.3, "persona_consistency": 0.5}, SEQ_LEN=3072) == "R9"


def test_patterns_that_match_nothing_in_the_test_tables(spark):
    from threadloom.plans import corpus

    ads = ["카톡 아이디: abcd12", "예약 문의 받아요", "선착순 30명", "오늘만 50% 할인", "무료 체험 신청", "입금 확인 후"]
    assert all(re.search("(?i)" + packs.AD, t) for t in ads) and not any(re.search("(?i)" + packs.AD, t) for t in ["보증금 문의했어요", "카톡으로 말했어", "50% 정도"])
    secrets = ["sk-" + "a1" * 10, "hf_" + "b" * 20, "AKIA" + "C3" * 8, 'token = "x"']
    assert one(spark, lambda c: c.rlike(packs.SECRET), *secrets, "token of thanks", None) == [True] * 4 + [False, None]
    assert one(spark, lambda c: c.rlike("|".join(packs.FORMAL_AI)), "죄송하지만 몰라요", "몰라") == [True, False]
    assert one(spark, lambda c: filters.proximity(c, packs.MINOR, packs.SEXUAL), f"{packs.MINOR[0]} 그리고 {packs.SEXUAL[0]}", packs.MINOR[0] + "가" * 80 + packs.SEXUAL[0], packs.SEXUAL[0]) == [True, False, False]
    assert re.search(filters.near_pattern(packs.MINOR, packs.SEXUAL), f"{packs.SEXUAL[0]} {packs.MINOR[0]}") and "secret_scan" in corpus.QUERIES


def test_term_fires_against_counting(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abㅋ가 ") for _ in range(rng.randrange(60))) for _ in range(200)] + [None, "", "가나" * 5000]
    terms = ["a", "ab", "aba", "ㅋㅋ", "가", "bb", "가나가", "zz"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    got = {r.term: (r.fires, r.rows_with) for r in metrics.term_fires(df, "t", terms).collect()}
    want = {x: (sum((t or "").count(x) for t in texts), sum(x in (t or "") for t in texts)) for x in terms}
    assert got == want
    assert {(r.fires, r.rows) for r in metrics.term_fires(df.limit(0), "t", terms).collect()} == {(0, 0)}


def test_running_sums_over_ranges(spark):
    rows = [(i, (i * 7) % 11) for i in random.Random(6).sample(range(500), 300)]
    df = spark.createDataFrame(rows, "k long, w long")
    for per in (1_000_000, 40):
        got = {r.k: r.rn for r in sampling.running(df, "k", "w", per).collect()}
        total, want = 0, {}
        for k, w in sorted(rows):
            total += w
            want[k] = total
        assert got == want
    assert sampling.row_numbers(df.limit(0), "k").collect() == []
    assert sorted(r.k for r in sampling.first_share(df, "k", 10).collect()) == sorted(k for k, _ in rows)[:10]


def test_quotas():
    assert sampling.largest_remainder({"a": 1, "b": 1}, 10, {"a": 2, "b": 100}) == {"a": 2, "b": 8}
    assert sampling.largest_remainder({"a": 1, "b": 1}, 10, {"a": 2, "b": 3}) == {"a": 2, "b": 3}
    assert sampling.equal_targets(["y", "x"], 5) == {"x": 3, "y": 2} and sampling.equal_targets([], 5) == {}
    assert sampling.round_robin({"a": 5, "b": 5}, {"a": 1, "b": 9}, 10) == {"a": 1, "b": 9} and sampling.round_robin({"a": 5}, {"a": 3}, 9) == {"a": 3}


def test_greedy_quota_against_the_loop(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("tu"), rng.choice("xyz"), rng.choice(["s1", "s1", "s1", "s2", "s3", None, ""]), f"{rng.random():.9f}") for i in range(400)]
    df = spark.createDataFrame(rows, "i long, task string, bucket string, src string, rank string")
    quotas, cap = {"t": 40, "u": 300}, 6
    got = {}
    for r in sampling.greedy_quota(df, "task", "bucket", "src", F.col("rank"), quotas, cap).collect():
        got.setdefault(r.task, set()).add(r.i)
    for t, q in quotas.items():
        mine = [r for r in rows if r[1] == t]
        sizes = {b: sum(r[2] == b for r in mine) for b in "xyz"}
        want = sampling.largest_remainder(sizes, min(q, len(mine)), sizes)
        taken, per = [], {}
        for phase in (0, 1):
            for r in sorted(mine, key=lambda r: (r[2], r[4]) if phase == 0 else r[4]):
                ok = len(taken) < q and r[0] not in taken and (phase == 1 or want[r[2]] > 0) and not (r[3] and per.get(r[3], 0) >= cap)
                if ok:
                    taken.append(r[0])
                    want[r[2]] -= 1
                    per[r[3]] = per.get(r[3], 0) + 1
        assert got[t] == set(taken)


def test_thread_greedy_and_clusters(spark):
    base = "the red fox ran home today past the old mill and the quiet river"
    rows = [(1, "t", "post", base), (2, "t", "comment", base + "!"), (3, "t", "comment", base + "!?"), (4, "t", "post", base), (5, "u", "comment", base), (6, "t", "comment", "something else entirely, of another kind"), (7, None, "comment", base), (8, "t", "comment", None)]
    df = spark.createDataFrame(rows, "k long, thread string, kind string, t string")
    got = {r.k: r.kept for r in dedup.thread_greedy(df, "k", "thread", "t", F.col("kind") == "post").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: True, 6: True, 7: True, 8: True}
    sizes = {r.keeper: r["size"] for r in dedup.minhash_clusters(df.where("k in (1, 4, 5, 6)"), "k", "t").collect()}
    assert sizes == {1: 3, 6: 1}


def test_thread_greedy_brute_and_no_gram_in_an_exchange(spark):
    """Small threads by one task, large ones by pairs: both as the sequential rule; a small thread's plan joins nothing."""
    rng = random.Random(11)
    base = ["the red fox ran home today past the old mill", "무인카페에서 후배가 노트북을 문의했더니 옆자리형이 벌써 예약했다고 하네요", "\U0001f600 quiet night 𝄞 at the old harbour, again and again and again"]
    rows = [(900, None, "comment", base[0]), (901, "t0", None, None), (902, "t0", "comment", "abc"), (903, "t0", "comment", "abc")]
    for i in range(240):
        t = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            t[rng.randrange(len(t))] = rng.choice("xyz! ")
        rows.append((i, f"t{rng.randrange(4)}", rng.choice(["post", "comment", "comment", "comment", None]), "".join(t)))
    rng.shuffle(rows)

    def grams(t):
        t = "".join((t or "").split())
        return {t[k : k + 4] for k in range(len(t) - 3)}

    want, stay = {}, {}
    for k, g, kind, t in sorted(rows, key=lambda r: r[0]):
        s = grams(t)
        want[k] = g is None or not s or kind == "post" or not any(round(len(s & o) / len(s | o), 6) >= 0.85 for o in stay.get(g, []))
        if want[k] and s:
            stay.setdefault(g, []).append(s)
    df = spark.createDataFrame(rows, "k long, g string, kind string, t string").repartition(3)
    assert len(set(want.values())) == 2
    for most in (1000, 60, 1):
        got = dedup.thread_greedy(df, "k", "g", "t", F.col("kind") == "post", whole_rows=most)
        assert {r.k: r.kept for r in got.collect()} == want, most
        if most == 1000:
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and plan.count("MapInArrow") == 1
    got = dedup.thread_greedy(df, "k", "g", "t", F.col("kind") == "post", whole_chars=300)
    assert {r.k: r.kept for r in got.collect()} == want


def test_first_wins_with_null_keys(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", "x"), (4, None, None), (5, None, None)], "o long, k string, v string")
    assert sorted(r.o for r in dedup.first_wins(df, [F.col("k"), F.col("v")], "o").collect()) == [1, 2, 4]


def test_bursts_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice("ab"), rng.randrange(40_000)) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, who string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.i: r.in_window for r in filters.bursts(df, "who", "ts", 4, 3600).collect()}
    want = {i: sum(w == x and s - 3600 <= t <= s for _, x, t in rows) for i, w, s in rows}
    assert got == {i: n for i, n in want.items() if n >= 4}


def test_examples_of_all_kinds(spark):
    full = examples.chat_text("s", F.lit("hello there"), F.lit("well well done"))
    e = examples.chat_example(full, 50)
    r = spark.range(1).select(full.alias("f"), *[c.alias(k) for k, c in e.items()]).first()
    n = len(r.f.split())
    assert len(r.input_ids) == n and [x != -100 for x in r.labels].count(True) == 3 and r.trainable
    r = spark.range(1).select(*[c.alias(k) for k, c in examples.chat_example(F.lit("no mark here"), 50).items()]).first()
    assert r.labels == r.input_ids
    df = spark.createDataFrame([("i", "x", "o", None, None), (None, None, None, "p", "c"), ("i", None, " ", None, None)], "i string, x string, o string, p string, c string")
    b = examples.prompt_and_answer(*[F.col(k) for k in "ixopc"])
    assert [tuple(r) for r in df.select(*[c.alias(k) for k, c in b.items()]).collect()] == [("instruction", "i\nx\n", "o"), ("post", "p\n", "c"), ("instruction", None, None)]


def test_late_rows_and_watermarks(spark, tmp_path):
    from threadloom.streaming import events as st

    at = lambda h: f"2024-01-01 {h:02d}:10:00"
    batches = [[(1, 1), (2, 2)], [(3, 9)], [(5, 10)], [(4, 3), (6, 12)]]  # event 4 comes nine hours late
    for b in batches:
        df = spark.createDataFrame([(e, at(h), 7, "view", 1.0, None) for e, h in b], "event_id long, ts string, user_id long, event_type string, value double, props string")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = st.run(spark, str(tmp_path / "in"), lambda df: st.tumbling(df, "1 hour", "1 hour"))
    assert sorted((r.start.hour, r.n) for r in out.collect()) == [(1, 1), (2, 1), (9, 1), (10, 1)]  # 3 was late, 12 is open
    assert sorted(r.event_id for r in st.run(spark, str(tmp_path / "in"), st.deduplicated).collect()) == [1, 2, 3, 5, 6]
    assert [r.user_id for r in st.run(spark, str(tmp_path / "in"), lambda df: st.cap_alarms(df, 4.0)).collect()] == [7]


def test_masked_labels_keep_long_answers(spark, tmp_path):
    from threadloom.plans import building

    rows = [(1, "질문 " * 150, "답변 " * 200)]
    spark.createDataFrame(rows, "row_id long, instruction string, output string").write.parquet(f"{tmp_path}/round2_build_tc_sft.parquet")
    got = building.QUERIES["masked_labels"][0](spark, str(tmp_path)).first()
    assert 128 < len(got.input_ids) <= 1024 and len(got.labels) == len(got.input_ids) and got.trainable
