import random
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from threadloom.llm import splits, visual


def one(*texts):
    return visual.unify_array(pa.array(texts, pa.string())).to_pylist()


def test_forms():
    assert one("ＰΑSＳ ４８호점", "Моｏｎ", "a​b﻿c­", "x y　z", None, "") == ["PASS 48호점", "Moon", "abc", "x y z", None, ""]
    assert one(unicodedata.normalize("NFD", "각낙 é가"), "ﾻﾻ", "ᄏᄏ", "ｶﾞ") == ["각낙 é가", "ㅋㅋ", "ㅋㅋ", "ガ"]
    assert one("a\nb", "O0", "lI", "a  b", "crème") == ["a\nb", "O0", "lI", "a  b", "crème"]


def test_composition_agrees_with_the_standard():
    rng = random.Random(4)
    pool = "가각힣aeoEnu " + "".join(map(chr, [0x301, 0x300, 0x308, 0x327, 0x323, 0x1112, 0x1161, 0x11AB, 0x304B, 0x3099]))
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(400)]
    lone = str.maketrans({chr(0x1112): "ㅎ", chr(0x1161): "ㅏ", chr(0x11AB): "ㄴ"})
    assert one(*texts) == [unicodedata.normalize("NFC", t).translate(lone) for t in texts]


def test_same_look(spark):
    rows = [(1, "PASS"), (2, "ＰASS"), (3, "PASS"), (4, "РASS"), (5, "pass"), (6, None), (7, ""), (8, "​"), (9, "가" * 5000), (10, unicodedata.normalize("NFD", "가" * 5000)), (None, "PASS")]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("form", F.lit(1)).withColumn("s", F.lit("x"))
    got = {tuple(r) for r in visual.same_look(df, "id", "t").collect()}
    assert got == {(1, 2), (2, 3), (1, 4), (3, 4), (2, 4), (7, 8), (9, 10)}
    assert {tuple(r) for r in visual.same_look(df, "id", "t", part=1).collect()} == got  # spread
    assert visual.same_look(df.limit(0), "id", "t").collect() == [] == visual.looks(df.limit(0), "id", "t").collect()
    n = {}
    for a, b in got:
        n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
    assert {r.key: r.links for r in visual.looks(df, "id", "t").collect()} == {i: n.get(i, 0) for i in (1, 2, 3, 4, 5, 7, 8, 9, 10)}


def components(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        up[top(a)] = top(b)
    out = {}
    for x in list(up):
        out.setdefault(top(x), set()).add(x)
    return sorted(map(sorted, out.values()))


def test_components_random_chain_and_hub(spark):
    rng = random.Random(9)
    edges = [(f"n{rng.randrange(150)}", f"n{rng.randrange(150)}") for _ in range(110)]
    edges += [(f"c{i}", f"c{i + 1}") for i in range(70)] + [("hub", f"h{i}") for i in range(200)]
    df = spark.createDataFrame(edges + [("x", None), (None, None)] + edges[:5], "a string, b string").withColumn("node", F.lit(1))
    for small in (200_000, 3):  # the small graph in one task, and by search
        got = {}
        for r in splits.components(df, hot=50, small=small).collect():
            got.setdefault(r.comp, []).append(r.node)
        assert sorted(map(sorted, got.values())) == components(edges)


def test_components_of_names_without_hashes(spark):
    from threadloom.session import Stage

    rng = random.Random(3)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(45)] + [(f"c{i}", f"c{i + 1}") for i in range(20)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame(edges, "a string, b string")
    for small in (200_000, 1):
        got = {}
        for r in splits._labels(df.unionByName(df.toDF("b", "a")).distinct(), Stage(spark, "t"), 20, small).collect():
            got.setdefault(r.label, []).append(r.node)
        assert sorted(map(sorted, got.values())) == components(edges)


def test_pairs_and_splits(spark):
    rows = [("1", "a", "K"), ("2", "b", " k "), ("3", "b", "anon"), ("4", "c", None), ("5", None, "k"), ("6", None, None), ("7", "d", "ㅇㅇ"), ("8", "b", "K")]
    df = spark.createDataFrame(rows, "rec string, grp string, author string").withColumn("owner", splits.identity(F.col("author")))
    assert {tuple(r) for r in splits.linked_pairs(df).collect()} == {("a", "b")}
    assert {(r.grp, r.links) for r in splits.linked_members(df).collect()} == {("a", 1), ("b", 1), ("c", 0), ("d", 0)}
    star = spark.createDataFrame([(str(i), f"g{i}", "x") for i in range(40)], "rec string, grp string, owner string")
    assert splits.linked_pairs(star, part=7).distinct().count() == 40 * 39 // 2 == splits.linked_pairs(star).count()
    got = {r.rec: r for r in splits.assign(df).collect()}
    assert len(got) == 8 and len({got[k].split for k in ("1", "2", "3", "5", "8")}) == 1 and got["6"].comp != got["4"].comp
    big = spark.range(4000).select(F.col("id").cast("string").alias("rec"), (F.col("id") % 1000).cast("string").alias("grp"), F.lit(None).cast("string").alias("owner"))
    n = {r.split: r["count"] for r in splits.assign(big).groupBy("split").count().collect()}
    assert abs(n["train"] - 3200) <= 8 and abs(n["test"] - 400) <= 8
    assert splits.assign(df.limit(0)).collect() == [] and splits.linked_pairs(df.limit(0)).collect() == []
