import random

from threadloom.operators.hierarchy import audit, descendants, nested_sets

SCHEMA = "node_id string, parent_id string, root_id string, depth int"


def brute(par):
    out = {}
    for n in par:
        x, seen = n, []
        while x in par and x not in seen:
            seen.append(x)
            x = par[x]
        if x in seen:
            out[n] = ("cycle" if x == n else "below_cycle", None, None)
        elif x is not None and x.endswith(":[root]"):
            out[n] = ("rooted", x[:-7], seen[::-1])
        else:
            out[n] = ("detached", x, seen[::-1])
    return out


def run(spark, par):
    rows = [(n, p, None, None) for n, p in par.items()]
    tree = nested_sets(spark.createDataFrame(rows, SCHEMA), with_path=True)
    return tree, {r.node: r for r in tree.collect()}


def test_random_forests(spark):
    rng = random.Random(5)
    for trial in range(3):
        names = [f"t:{i}" for i in range(120)]
        par = {}
        for i, n in enumerate(names):
            par[n] = rng.choice(["a:[root]", "b:[root]", "gone", None] + names[max(0, i - 3) : i] * 4 + ([names[-1 - i]] if trial else []))
        want = brute(par)
        tree, got = run(spark, par)
        assert {n: (r.status, r.root, r.path) for n, r in got.items()} == want
        by = {}
        for r in got.values():
            if r.pre is not None:
                by.setdefault((r.status, r.root), []).append(r)
        for rs in by.values():
            assert sorted(r.pre for r in rs) == list(range(1, len(rs) + 1))
        pairs = {(a, n) for n, (_, _, path) in want.items() if path for a in path[:-1]}
        assert {tuple(r) for r in descendants(tree, spark.createDataFrame([(n,) for n in names], "node string")).collect()} == pairs


def test_long_chain_self_loop_and_hot_parent(spark):
    par = {"c0": "x:[root]"} | {f"c{i}": f"c{i - 1}" for i in range(1, 300)}
    par |= {"s": "s", "u": "s"} | {f"h{i}": "c0" for i in range(500)}
    _, got = run(spark, par)
    assert got["c299"].depth == 300 and got["c0"].size == 800
    assert got["s"].status == "cycle" and got["u"].status == "below_cycle"


def test_nulls_repeats_empty_and_clashing_columns(spark):
    rows = [("a", "t:[root]", "t", 1), ("a", "t:[root]", "t", 2), ("b", "a", None, None), (None, "a", "t", 1), ("n", None, "t", 1), ("b", "a", "u", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    clash = df.withColumn("size", F.lit("x")).withColumn("path", F.lit(1)).withColumn("jump", F.lit(1)).withColumn("node", F.lit(1))
    tree = nested_sets(clash)
    assert {tuple(r) for r in audit(df, tree).collect()} == {("a", "wrong_depth"), ("b", "wrong_root"), ("n", "detached")}
    assert nested_sets(df.limit(0)).collect() == []
