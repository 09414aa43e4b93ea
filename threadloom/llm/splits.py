"""Splits that keep related records together.

Records are joined by their group (thread) and their identified owner (author). The components of that
bipartite graph are found by breadth-first search from many seeds at once:

* nodes are 64-bit hashes of their names, checked to be distinct (else the names themselves are the nodes);
* adjacency lists are hash-partitioned and sorted once; lists longer than ``hot`` are cut into salted parts;
* every node whose hash is smallest among its neighbours is a seed and expands its ball with all others,
  one frontier step per round, until all nodes are labelled. Every component has such a node, and a chain
  of falling hashes leads to one from anywhere, so the rounds are few even for long components;
* seeds whose balls touch form a small graph. Up to ``small`` links it is solved in one task; a larger one is
  searched the same way until it is small.

A component's number is the smallest hash of its nodes. Components are laid out in the order of a hash of that
number and cut at the proportions, counted in records.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Stage

# Names that identify nobody.
NOBODY = ["", "anon", "ㅇㅇ", "익명", "탈퇴회원"]


def identity(author: Column) -> Column:
    """The author as compared: without case and outer blanks; null where nobody is identified."""
    a = F.lower(F.regexp_replace(author, r"(?U)^\s+|\s+$", ""))
    return F.when(~a.isin(NOBODY), a)


def _solve(batches):
    """Components of all links of one bounded task: every label with the smallest it is linked to."""
    batches = list(batches)  # at most `small` links
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    names = pc.unique(pa.chunked_array([*t.column("a").chunks, *t.column("b").chunks]))
    names = names.take(pc.sort_indices(names))
    x, y = (pc.index_in(t.column(c), names).combine_chunks().to_numpy() for c in ("a", "b"))
    up = np.arange(len(names))
    while True:
        px, py = up[x], up[y]
        if (px == py).all():
            break
        np.minimum.at(up, np.maximum(px, py), np.minimum(px, py))
        while (up[up] != up).any():
            up = up[up]
    yield pa.RecordBatch.from_arrays([names, names.take(pa.array(up))], names=["label", "to"])


def _labels(edges: DataFrame, st: Stage, hot: int, small: int, depth: int = 0) -> DataFrame:
    """``edges (a, b)`` in both directions, each once, a <> b -> ``(node, label)``, one label per component."""
    kind = dict(edges.dtypes)["a"]
    key = lambda c: F.struct(F.xxhash64(F.lit(depth), c), c) if depth or kind == "string" else F.col(c)
    edges, n = st.cut_counted(edges)
    per = edges.groupBy("a").agg(F.count("*").alias("deg"), F.min(key("b")).alias("low"))
    nodes = st.cut(per.select(F.col("a").alias("node"), F.ceil(F.col("deg") / hot).cast("int").alias("parts"), (key("a") < F.col("low")).alias("seed")))
    # the adjacency, hash-partitioned and sorted once and kept; a lost part is built again from the edges
    many = nodes.where("parts > 1").select("node", "parts")
    adj = edges.join(many.toDF("a", "ap"), "a", "left").join(many.toDF("b", "bp"), "b", "left")
    adj = adj.select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("ap")).cast("int"), F.lit(0)).alias("part"), F.coalesce("bp", F.lit(1)).alias("parts"))
    parts = max(-(-n // 2_000_000), int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    adj = adj.repartition(parts, "a", "part").sortWithinPartitions("a", "part").persist(StorageLevel.MEMORY_AND_DISK)

    name = f"seen{depth}"
    frontier, grown = st.cut_counted(nodes.where("seed").select("node", F.col("node").alias("label"), "parts"))
    seen, _ = st.add(frontier, name)
    while grown:
        go = frontier.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        go = go.select(F.col("node").alias("a"), "label", "part").hint("merge")
        reach = go.join(adj, ["a", "part"]).select(F.col("b").alias("node"), "label", "parts", F.lit(0).alias("old"))
        known = seen.select("node", "label", "parts", F.lit(1).alias("old"))
        # one exchange: what is reached meets what was seen, by node
        fresh = reach.unionByName(known).groupBy("node").agg(F.min("label").alias("label"), F.max("parts").alias("parts"), F.max("old").alias("old"))
        frontier, grown = st.cut_counted(fresh.where("old = 0").select("node", "label", "parts"))
        if grown:
            seen, _ = st.add(frontier, name)
    labels = seen.select("node", "label")

    # balls that touch: a small graph of labels
    la, lb = labels.toDF("a", "x").hint("merge"), labels.toDF("b", "y").hint("merge")
    touch, n = st.cut_counted(adj.select("a", "b").where("a < b").join(la, "a").join(lb, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    adj.unpersist()
    if not n:
        return labels
    if n <= small:
        merged = touch.coalesce(1).mapInArrow(_solve, f"label {kind}, to {kind}")
    else:
        merged = _labels(touch.unionByName(touch.toDF("b", "a")), st, hot, small, depth + 1).toDF("label", "to")
        # the smallest label of each, as in the small graph
        merged = merged.join(merged.groupBy("to").agg(F.min("label").alias("low")), "to").select("label", F.col("low").alias("to"))
    return st.cut(labels.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def components(edges: DataFrame, hot: int = 20_000, small: int = 200_000) -> DataFrame:
    """Undirected ``edges (a, b)`` -> ``(node, comp)`` for every node that occurs in an edge.

    ``comp`` is the same for the nodes of a component and for no others: the smallest hash of their names, or the
    smallest name should two names have one hash. Rows with a null end are no edges, repeated edges count once,
    an edge from a node to itself makes the node known. No edges give no rows.
    """
    st = Stage(edges.sparkSession, "components")
    e = st.cut(edges.select("a", "b").where("a is not null and b is not null").distinct())
    names, n = st.cut_counted(e.select(F.col("a").alias("node")).unionByName(e.select(F.col("b").alias("node"))).distinct().withColumn("id", F.xxhash64("node")))
    if names.select("id").distinct().count() < n:
        names = names.withColumn("id", F.col("node"))
        ids = e
    else:
        ids = e.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))
    ids = ids.where("a <> b")
    labels = _labels(ids.unionByName(ids.toDF("b", "a")).distinct(), st, hot, small)
    return st.cut(names.join(labels.withColumnRenamed("node", "id"), "id", "left").select("node", F.coalesce("label", "id").alias("comp")))


def linked_groups(records: DataFrame) -> DataFrame:
    """``records (grp, owner)`` -> ``(grp, comp)`` for every non-null group; owners as by ``identity``."""
    r = records.select("grp", "owner").where("grp is not null").distinct()
    g = F.concat(F.lit("g:"), "grp")
    e = r.select(g.alias("a"), F.coalesce(F.concat(F.lit("o:"), "owner"), g).alias("b"))
    return components(e).where("node like 'g:%'").select(F.expr("substr(node, 3)").alias("grp"), "comp")


def linked_members(records: DataFrame) -> DataFrame:
    """``(grp, comp, links)``: every non-null group with its component and the number of other groups in it."""
    g = linked_groups(records)
    return g.join(g.groupBy("comp").agg((F.count("*") - 1).alias("links")), "comp").select("grp", "comp", "links")


def linked_pairs(records: DataFrame, part: int = 1000) -> DataFrame:
    """All pairs ``(id_a, id_b)``, id_a < id_b, of different groups in one component.

    The pairs of a large component are spread: its left ids go to one of as many parts as it has times ``part``
    groups, its right ids to all of them.
    """
    g = linked_members(records).where("links > 0").withColumn("parts", F.floor(F.col("links") / part).cast("int") + 1)
    a = g.select("comp", F.pmod(F.xxhash64("grp"), F.col("parts")).cast("int").alias("part"), F.col("grp").alias("id_a"))
    b = g.select("comp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("grp").alias("id_b"))
    return a.join(b, ["comp", "part"]).where("id_a < id_b").select("id_a", "id_b")


def assign(records: DataFrame, shares: dict[str, float] | None = None, slices: int = 4096) -> DataFrame:
    """``records (rec, grp, owner)`` -> ``(rec, comp, split)``; every row of the input gets a split. ``rec`` is not null.

    A record without group joins its owner's component but links nothing; without either it stands alone.
    Components follow each other in hash order; the middle of a component's stretch of records decides,
    so a component is never cut, and proportions are off by at most the component at a border.
    The prefix sums go over hash slices: one sum per slice, then within each slice.
    """
    spark = records.sparkSession
    st = Stage(spark, "splits")
    shares = shares or {"train": 0.8, "validation": 0.1, "test": 0.1}
    r = records.select("rec", "grp", "owner")
    group, owner = F.concat(F.lit("g:"), "grp"), F.concat(F.lit("o:"), "owner")
    r = r.withColumn("node", F.coalesce(group, owner, F.concat(F.lit("r:"), "rec")))
    comp = components(r.select(F.col("node").alias("a"), F.when(F.col("grp").isNotNull(), F.coalesce(owner, F.col("node"))).otherwise(F.col("node")).alias("b")))
    r = r.join(comp, "node").select("rec", "comp")
    r = st.cut(r)
    size = r.groupBy("comp").agg(F.count("*").alias("n")).withColumn("h", F.xxhash64("comp"))
    size = st.cut(size.withColumn("slice", F.shiftrightunsigned("h", 52).cast("int") % slices))
    lead = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # at most `slices` rows
    tot = size.groupBy("slice").agg(F.sum("n").alias("t"))
    tot = tot.withColumn("lead", F.coalesce(F.sum("t").over(lead), F.lit(0))).withColumn("all", F.sum("t").over(Window.partitionBy()))
    inner = Window.partitionBy("slice").orderBy("h", "comp").rowsBetween(Window.unboundedPreceding, -1)
    at = size.withColumn("before", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(F.broadcast(tot), "slice")
    mid = (F.col("lead") + F.col("before") + F.col("n") / 2) / F.col("all")
    cut, total, names = 0.0, sum(shares.values()), list(shares)
    pick = F.lit(names[-1])
    edges = []
    for s in names[:-1]:
        cut += shares[s] / total
        edges.append((cut, s))
    for c, s in reversed(edges):
        pick = F.when(mid < c, F.lit(s)).otherwise(pick)
    return r.join(at.select("comp", pick.alias("split")), "comp").select("rec", "comp", "split")
