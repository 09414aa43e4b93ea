"""Parent-child links to full hierarchies, as nested sets.

Every node gets its depth, the end of its parent chain, its subtree size and a preorder number
that is consecutive within a root's tree, so that

* the descendants of ``v`` are exactly the nodes of the same root with
  ``v.pre < pre < v.pre + v.size``, and
* the ancestors of ``v`` are the nodes with ``a.pre < v.pre < a.pre + a.size``.

Sizes are summed upward and preorder ranges handed downward. Both run along chains whose length is
unknown and may be thousands, so neither goes level by level: in round k every node holds a link to
its ancestor 2^k above together with what lies between, and adds what that ancestor holds. A tree of
depth d takes log2(d) rounds. Nodes that never reach the end of a chain are those on loops or below
them; they are told apart at the end, because 2^k steps map the nodes of a loop onto themselves and
all nodes below it into it.

Rows are never gathered per tree or per parent: sizes are summed with map-side partial aggregates, and
the prefix sums over siblings go through hash buckets, so one post with a third of all replies is
spread over ``buckets`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Stage

OK, DETACHED, CYCLE, BELOW = "rooted", "detached", "cycle", "below_cycle"


def nested_sets(
    links: DataFrame,
    node: str = "node_id",
    parent: str = "parent_id",
    root_pattern: str = r"^(.*):\[root\]$",
    with_path: bool = False,
    buckets: int = 32,
) -> DataFrame:
    """``links`` (one or more rows per node) -> one row per node.

    Result: ``node, parent, status, root, depth, pre, size`` and, with ``with_path``, ``path`` (array from
    the node under the root down to the node itself).

    * ``status``: ``rooted`` (the chain reaches a parent that matches ``root_pattern``; ``root`` is its
      first group), ``detached`` (the chain ends at a parent that is no node, or at null; ``root`` is that
      parent), ``cycle`` or ``below_cycle`` (``root, depth, pre, size, path`` are null).
    * ``depth`` counts links to the end of the chain; ``size`` counts the node itself.
    * Rows with a null node are no nodes. Repeated rows count once; where rows of one node disagree
      about the parent, the smallest non-null parent holds. A node that is its own parent is a cycle.
      An empty input gives an empty result. Other columns, whatever their names, are ignored.
    """
    spark = links.sparkSession
    st = Stage(spark, "hierarchy")
    base = (
        links.select(F.col(node).alias("node"), F.col(parent).alias("parent"))
        .where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("parent").alias("parent"))
    )
    known = base.select(F.col("node").alias("parent"), F.lit(True).alias("up"))
    base = st.cut(base.join(known, "parent", "left").withColumn("up", F.col("up").isNotNull()))

    # upward: sizes. jump(v) = ancestor 2^k above v, or null once the chain has ended within 2^k links.
    # Nodes that have ended stay in `done`, and only live ones take part in the next round.
    cols = ["node", "jump", "steps", "size", "last"]
    extra = [F.array("node").alias("path")] if with_path else []
    if with_path:
        cols.append("path")
    state = base.select(
        "node",
        F.when(F.col("up"), F.col("parent")).alias("jump"),
        F.lit(1).cast("long").alias("steps"),
        F.lit(1).cast("long").alias("size"),
        F.when(~F.col("up"), F.coalesce("parent", F.lit(""))).alias("last"),
        *extra,
    )
    state = st.cut(state)
    # A chain that ends loses live nodes in every round, so once a round loses none only loops and what
    # hangs below them are live; 2^k >= live steps then lead from any of them onto its loop.
    span, live, before, old = 1, state.where(F.col("jump").isNotNull()).count(), None, None
    while live and not (live == before and span >= live):
        before = live
        gain = (
            state.where(F.col("jump").isNotNull())
            .groupBy(F.col("jump").alias("node"))
            .agg(F.sum("size").alias("gain"))
        )
        above = state.select(
            F.col("node").alias("jump"),
            F.col("jump").alias("jump2"),
            F.col("steps").alias("steps2"),
            F.col("last").alias("last2"),
            *([F.col("path").alias("path2")] if with_path else []),
        )
        nxt = state.where(F.col("jump").isNotNull()).join(above, "jump")
        nxt = nxt.select(
            "node",
            F.col("jump2").alias("jump"),
            (F.col("steps") + F.col("steps2")).alias("steps"),
            "size",
            F.col("last2").alias("last"),
            *([F.concat("path2", "path").alias("path")] if with_path else []),
        )
        nxt = nxt.unionByName(state.where(F.col("jump").isNull()))
        nxt = nxt.join(gain, "node", "left").withColumn("size", F.col("size") + F.coalesce("gain", F.lit(0)))
        nxt = st.cut(nxt.select(*cols))
        if old is not None:
            st.drop(old)
        old, state = state, nxt
        span *= 2
        live = state.where(F.col("jump").isNotNull()).count()

    # loops: what 2^k steps lead to, with 2^k no less than the number of live nodes, lies on a loop
    on_loop = state.where(F.col("jump").isNotNull()).select(F.col("jump").alias("node")).distinct().withColumn("loop", F.lit(True))

    # downward: offsets among siblings by two-level prefix sums, then sums of offsets along the chain
    ended = state.where(F.col("jump").isNull())
    sib = ended.select("node", "size", "steps", "last", *(["path"] if with_path else [])).join(base.select("node", "parent"), "node")
    sib = sib.withColumn("sib", F.coalesce("parent", F.lit(""))).withColumn("b", F.pmod(F.xxhash64("node"), F.lit(buckets)))
    within = Window.partitionBy("sib", "b").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    sib = sib.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    tot = sib.groupBy("sib", "b").agg(F.sum("size").alias("tot"))
    across = Window.partitionBy("sib").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("sib", "b", F.coalesce(F.sum("tot").over(across), F.lit(0)).alias("lead"))
    sib = sib.join(tot, ["sib", "b"]).withColumn("off", F.col("before") + F.col("lead") + 1)
    sib = st.cut(sib.select("node", "parent", "size", "steps", "last", "off", *(["path"] if with_path else [])))
    if old is not None:
        st.drop(old)

    top = sib.agg(F.max("steps")).first()[0] or 1
    pre = sib.select("node", F.when(F.col("steps") > 1, F.col("parent")).alias("jump"), F.col("off").alias("pre"))
    span, prev = 1, None
    while span < top:
        above = pre.select(F.col("node").alias("jump"), F.col("jump").alias("jump2"), F.col("pre").alias("pre2"))
        go = pre.where(F.col("jump").isNotNull()).join(above, "jump")
        go = go.select("node", F.col("jump2").alias("jump"), (F.col("pre") + F.col("pre2")).alias("pre"))
        nxt = st.cut(go.unionByName(pre.where(F.col("jump").isNull())))
        if prev is not None:
            st.drop(prev)
        pre = prev = nxt
        span *= 2

    root = F.regexp_extract("last", root_pattern, 1)
    rooted = F.col("last").rlike(root_pattern)
    good = sib.join(pre.select("node", "pre"), "node").select(
        "node",
        "parent",
        F.when(rooted, F.lit(OK)).otherwise(F.lit(DETACHED)).alias("status"),
        F.when(rooted, root).otherwise(F.nullif(F.col("last"), F.lit(""))).alias("root"),
        F.col("steps").alias("depth"),
        "pre",
        "size",
        *(["path"] if with_path else []),
    )
    bad = (
        state.where(F.col("jump").isNotNull())
        .select("node")
        .join(on_loop, "node", "left")
        .join(base.select("node", "parent"), "node")
        .select(
            "node",
            "parent",
            F.when(F.col("loop"), F.lit(CYCLE)).otherwise(F.lit(BELOW)).alias("status"),
            F.lit(None).cast("string").alias("root"),
            F.lit(None).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("pre"),
            F.lit(None).cast("long").alias("size"),
            *([F.lit(None).cast("array<string>").alias("path")] if with_path else []),
        )
    )
    return good.unionByName(bad)


def descendants(tree: DataFrame, of: DataFrame, node: str = "node", bins: int = 64) -> DataFrame:
    """``(ancestor, node)`` for every node of ``of`` (column ``node``) and each of its descendants.

    A range join inside one root: query ranges are cut at multiples of a power-of-four width near their
    own length, so a range covers a few cells only and each tree node is looked up in one cell per width.
    """
    tree = tree.where(F.col("pre").isNotNull()).withColumn("root", F.coalesce("root", F.lit("")))  # a null parent is an end, too
    q = of.select(F.col(node).alias("node")).distinct().join(tree, "node").where(F.col("size") > 1)
    width = F.pow(F.lit(4.0), F.ceil(F.log(F.col("size").cast("double")) / F.log(F.lit(4.0)))).cast("long")
    q = q.select(F.col("node").alias("ancestor"), "status", "root", F.col("pre").alias("lo"), (F.col("pre") + F.col("size")).alias("hi"), width.alias("w"))
    widths = q.select("w", "root", "status").distinct()
    q = q.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / F.col("w")), F.floor((F.col("hi") - 1) / F.col("w")))))
    t = tree.select("node", "status", "root", "pre")
    t = t.join(widths, ["root", "status"]).withColumn("cell", F.floor(F.col("pre") / F.col("w")))
    hit = q.join(t, ["root", "status", "w", "cell"])
    return hit.where((F.col("pre") > F.col("lo")) & (F.col("pre") < F.col("hi"))).select("ancestor", "node")


def audit(links: DataFrame, tree: DataFrame, node: str = "node_id", root: str = "root_id", depth: str = "depth") -> DataFrame:
    """``(node_id, finding)``: structure faults of ``tree`` and stale stored ``root``/``depth`` of ``links``.

    A stored null is no finding; a node with several rows has a finding if any of them is stale.
    """
    faults = tree.where(F.col("status") != OK).select(F.col("node").alias("node_id"), F.col("status").alias("finding"))
    stored = links.select(F.col(node).alias("node"), F.col(root).cast("string").alias("s_root"), F.col(depth).cast("long").alias("s_depth"))
    stored = stored.where(F.col("node").isNotNull() & (F.col("s_root").isNotNull() | F.col("s_depth").isNotNull()))
    good = tree.where(F.col("status") == OK).select("node", F.col("root").alias("t_root"), F.col("depth").alias("t_depth"))
    stale = (
        stored.join(good, "node")
        .select(
            F.col("node").alias("node_id"),
            F.explode(
                F.array(
                    F.when(F.col("s_root") != F.col("t_root"), F.lit("wrong_root")),
                    F.when(F.col("s_depth") != F.col("t_depth"), F.lit("wrong_depth")),
                )
            ).alias("finding"),
        )
        .where(F.col("finding").isNotNull())
        .distinct()
    )
    return faults.unionByName(stale)
