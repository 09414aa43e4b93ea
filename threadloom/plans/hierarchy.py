"""Queries of problem 4 over round2_build_tc_sft."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import hierarchy
from ..session import table

T = "round2_build_tc_sft"


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = table(spark, sf_dir, T, "node_id", "parent_id", "root_id", "depth")
    return hierarchy.audit(links, hierarchy.nested_sets(links))


def p4_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per node: thread root, depth, full path and number of descendants."""
    tree = hierarchy.nested_sets(table(spark, sf_dir, T, "node_id", "parent_id"), with_path=True)
    return tree.select(
        F.col("node").alias("node_id"),
        "status",
        F.when(F.col("status") == "rooted", F.col("root")).alias("thread_root"),
        F.col("depth").alias("true_depth"),
        F.array_join("path", " > ").alias("path"),
        (F.col("size") - 1).alias("descendants"),
    )


def p4_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All descendants of every node, as pairs read off the nested sets."""
    links = table(spark, sf_dir, T, "node_id", "parent_id")
    tree = hierarchy.nested_sets(links)
    return hierarchy.descendants(tree, links.select(F.col("node_id").alias("node"))).select(
        F.col("ancestor").alias("node_id"), F.col("node").alias("descendant_id")
    )


_WALK = f"""
WITH RECURSIVE e AS (
  SELECT node_id AS node, min(parent_id) AS parent FROM {T} WHERE node_id IS NOT NULL GROUP BY node_id
), w AS (
  SELECT node, parent AS cur, [node] AS path, FALSE AS looped FROM e
  UNION ALL
  SELECT w.node, e.parent, list_append(w.path, e.node), list_contains(w.path, e.parent)
  FROM w JOIN e ON e.node = w.cur WHERE NOT w.looped AND NOT list_contains(w.path, w.cur)
), fin AS (
  SELECT w.node, w.cur, w.path, w.cur IS NOT NULL AND list_contains(w.path, w.cur) AS looped
  FROM w WHERE list_contains(w.path, w.cur) OR NOT EXISTS (SELECT 1 FROM e WHERE e.node = w.cur)
), t AS (
  SELECT node, path, len(path) AS depth,
         CASE WHEN looped AND cur = node THEN 'cycle' WHEN looped THEN 'below_cycle'
              WHEN cur LIKE '%:[root]' THEN 'rooted' ELSE 'detached' END AS status,
         CASE WHEN NOT looped AND cur LIKE '%:[root]' THEN left(cur, length(cur) - 7) END AS root
  FROM fin
)
"""

P4_FOUND_SQL = (
    _WALK
    + f"""
SELECT node AS node_id, status AS finding FROM t WHERE status <> 'rooted'
UNION
SELECT r.node_id, 'wrong_root' FROM {T} r JOIN t ON t.node = r.node_id WHERE t.status = 'rooted' AND r.root_id <> t.root
UNION
SELECT r.node_id, 'wrong_depth' FROM {T} r JOIN t ON t.node = r.node_id WHERE t.status = 'rooted' AND r.depth <> t.depth
"""
)

P4_HIERARCHY_SQL = (
    _WALK
    + """
, pairs AS (SELECT t.node AS d, a.u AS anc FROM t, LATERAL (SELECT unnest(t.path) AS u) a WHERE t.status IN ('rooted', 'detached'))
, cnt AS (SELECT anc, count(*) - 1 AS n FROM pairs GROUP BY anc)
SELECT t.node AS node_id, t.status, t.root AS thread_root,
       CASE WHEN t.status IN ('rooted', 'detached') THEN CAST(t.depth AS BIGINT) END AS true_depth,
       CASE WHEN t.status IN ('rooted', 'detached') THEN array_to_string(list_reverse(t.path), ' > ') END AS path,
       CAST(cnt.n AS BIGINT) AS descendants
FROM t LEFT JOIN cnt ON cnt.anc = t.node
"""
)

P4_DESCENDANTS_SQL = (
    _WALK
    + """
SELECT a.u AS node_id, t.node AS descendant_id
FROM t, LATERAL (SELECT unnest(t.path) AS u) a
WHERE t.status IN ('rooted', 'detached') AND a.u <> t.node
"""
)

QUERIES = {
    "p4_found": (p4_found, P4_FOUND_SQL),
    "p4_hierarchy": (p4_hierarchy, P4_HIERARCHY_SQL),
    "p4_descendants": (p4_descendants, P4_DESCENDANTS_SQL),
}
