"""Lookups by several keys, held-out indexes, leak counts and alignment with the raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import examples
from ..session import table

Q: dict = {}
T = "round2_build_tc_sft"
P = "phase1_data_pipeline"


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{text.WS}+|{text.WS}+$', '', 'g')"


_TAG = r"^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\][ \t\n\r\f\x0b]*"


def digest(c) -> F.Column:
    return F.sha2(text.strip(c), 256)


@query("post_lookup_two_keys", f"""
WITH p AS (SELECT source_id, thread_key, text, record_id FROM {P} WHERE kind = 'post'), a AS (SELECT source_id AS k, max_by(text, record_id) AS t FROM p WHERE source_id IS NOT NULL GROUP BY 1), b AS (SELECT thread_key AS k, max_by(text, record_id) AS t FROM p WHERE thread_key IS NOT NULL GROUP BY 1)
SELECT v.valid_id, coalesce(a.t, b.t) AS post_text, CASE WHEN a.t IS NOT NULL THEN 'source_id' WHEN b.t IS NOT NULL THEN 'thread_key' END AS found_by FROM valid v LEFT JOIN a ON a.k = v.source_id LEFT JOIN b ON b.k = v.source_id""")
def post_lookup_two_keys(s, d):
    """A row's post by its source id, else by its thread key; the last post of a key wins."""
    p = table(s, d, P, "record_id", "kind", "source_id", "thread_key", "text").where("kind = 'post'")
    last = lambda k, name: p.where(F.col(k).isNotNull()).groupBy(F.col(k).alias("source_id")).agg(F.max_by("text", "record_id").alias(name))
    j = table(s, d, "valid", "valid_id", "source_id").join(last("source_id", "a"), "source_id", "left").join(last("thread_key", "b"), "source_id", "left")
    return j.select("valid_id", F.coalesce("a", "b").alias("post_text"), F.when(F.col("a").isNotNull(), "source_id").when(F.col("b").isNotNull(), "thread_key").alias("found_by"))


@query("context_raw_join", rf"""
WITH r AS (SELECT row_id, root_id, regexp_replace(output, '{_TAG}', '') AS body FROM {T} WHERE output IS NOT NULL AND root_id IS NOT NULL), p AS (SELECT DISTINCT record_id, thread_key, text FROM {P} WHERE thread_key IS NOT NULL)
SELECT r.row_id, p.record_id FROM r JOIN p ON p.thread_key = r.root_id AND length(p.text) = length(r.body) AND p.text = r.body""")
def context_raw_join(s, d):
    """Replies that stand as rows of the raw table, by thread and text."""
    r = table(s, d, T, "row_id", "root_id", "output").where("output is not null and root_id is not null")
    r = r.select("row_id", F.col("root_id").alias("thread_key"), F.sha2(text.reply_parts(F.col("output"))["body"], 256).alias("h"))
    p = table(s, d, P, "record_id", "thread_key", "text").where("thread_key is not null").select("record_id", "thread_key", F.sha2("text", 256).alias("h"))
    return r.join(p, ["thread_key", "h"]).select("row_id", "record_id")


@query("eval_rows_unseen", f"""
SELECT row_id FROM {T} e WHERE split = 'eval' AND output IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {T} t WHERE t.split = 'train' AND {_strip('t.output')} = {_strip('e.output')}) AND NOT EXISTS (SELECT 1 FROM {T} t WHERE t.split = 'train' AND t.root_id = e.root_id)""")
def eval_rows_unseen(s, d):
    """Evaluation rows whose output and whose thread do not stand in training."""
    r = table(s, d, T, "row_id", "split", "output", "root_id").where("output is not null or split = 'train'").withColumn("h", digest(F.col("output")))
    t = r.where("split = 'train'")
    e = r.where("split = 'eval'").join(t.select("h").where("h is not null"), "h", "left_anti")
    return e.join(t.select("root_id").where("root_id is not null"), "root_id", "left_anti").select("row_id")


@query("completions_index_anti", f"""
WITH x AS (SELECT {_strip('text')} AS t FROM valid WHERE text IS NOT NULL UNION SELECT {_strip('output')} FROM {T} WHERE split = 'eval' AND output IS NOT NULL)
SELECT row_id FROM {T} WHERE split = 'train' AND output IS NOT NULL AND {_strip('output')} NOT IN (SELECT t FROM x WHERE t <> '')""")
def completions_index_anti(s, d):
    """Training rows outside the index of held-out completions: texts, and assistant turns inside message lists."""
    r = table(s, d, T, "row_id", "split", "instruction", "output").where("output is not null")
    chat = r.where("split = 'eval'").select(F.to_json(examples.messages(None, F.col("instruction"), F.col("output"))).alias("m"))
    turns = F.filter(F.from_json("m", "array<struct<role: string, content: string>>"), lambda x: x["role"] == "assistant")
    held = chat.select(F.explode(F.transform(turns, lambda x: x["content"])).alias("t")).unionByName(table(s, d, "valid", "text").select(F.col("text").alias("t")))
    held = held.where(text.strip(F.col("t")) != "").select(digest(F.col("t")).alias("h"))
    return r.where("split = 'train'").withColumn("h", digest(F.col("output"))).join(held, "h", "left_anti").select("row_id")


def _pairs(s, d) -> DataFrame:
    from . import building

    return building.preference_pairs(s, d)


def _pairs_sql() -> str:
    from . import building

    return building.QUERIES["preference_pairs"][1]


@query("pair_leak_counts", f"""
WITH x AS (SELECT {_strip('text')} AS t FROM valid WHERE text IS NOT NULL UNION SELECT {_strip('output')} FROM {T} WHERE split = 'eval' AND output IS NOT NULL), p AS ({_pairs_sql()})
SELECT count(*) AS pairs, count(*) FILTER ({_strip('chosen')} IN (SELECT t FROM x)) AS chosen_leaks, count(*) FILTER ({_strip('rejected')} IN (SELECT t FROM x)) AS rejected_leaks, min(length(chosen)) AS shortest_chosen, median(length(chosen)) AS middle_chosen, max(length(rejected)) AS longest_rejected,
 bool_and(chosen <> '' AND rejected <> '') AS complete FROM p""")
def pair_leak_counts(s, d):
    """Preference pairs: how many sides are held-out texts, lengths by side, and whether all are complete."""
    r = table(s, d, T, "split", "output").where("split = 'eval' and output is not null").select(F.col("output").alias("t"))
    x = r.unionByName(table(s, d, "valid", "text").where("text is not null").select(F.col("text").alias("t"))).select(digest(F.col("t")).alias("h")).distinct()
    mark = lambda df, c: df.withColumn("h", digest(F.col(c))).join(x.withColumn(f"in_{c}", F.lit(True)), "h", "left").drop("h")
    p = mark(mark(_pairs(s, d), "chosen"), "rejected")
    n = lambda c: F.length(c).cast("long")
    return p.agg(F.count("*").alias("pairs"), F.count("in_chosen").alias("chosen_leaks"), F.count("in_rejected").alias("rejected_leaks"), F.min(n("chosen")).alias("shortest_chosen"), F.median(n("chosen")).alias("middle_chosen"), F.max(n("rejected")).alias("longest_rejected"), F.bool_and((F.col("chosen") != "") & (F.col("rejected") != "")).alias("complete"))


_ARMS_SQL = rf"""
WITH raw AS (SELECT DISTINCT {_strip('text')} AS t FROM {P} WHERE text IS NOT NULL), titles AS (SELECT DISTINCT {_strip('post_title_clean')} AS t FROM {P} WHERE post_title_clean IS NOT NULL), out AS (SELECT node_id, max_by(output, row_id) AS o FROM {T} WHERE output IS NOT NULL GROUP BY node_id),
a AS (SELECT row_id, 'title' AS arm, {_strip("regexp_extract(instruction, '^\\[POST-TITLE\\] ?(.*)', 1)")} IN (SELECT t FROM titles) AS hit FROM {T} WHERE instruction IS NOT NULL
 UNION ALL SELECT row_id, 'output', {_strip('output')} IN (SELECT t FROM raw) FROM {T} WHERE output IS NOT NULL
 UNION ALL SELECT row_id, 'comment', {_strip(f"regexp_replace(output, '{_TAG}', '')")} IN (SELECT t FROM raw) FROM {T} WHERE output IS NOT NULL
 UNION ALL SELECT r.row_id, 'reply_pair', out.o IS NOT NULL FROM {T} r LEFT JOIN out ON out.node_id = r.parent_id WHERE r.parent_id IS NOT NULL AND NOT ends_with(r.parent_id, '[root]'))
"""


def _arms(s, d) -> DataFrame:
    """``(row_id, arm, hit)``: every row by every arm it has a value for."""
    r = table(s, d, T, "row_id", "instruction", "output", "node_id", "parent_id")
    raw = table(s, d, P, "text", "post_title_clean")
    known = lambda c: raw.where(F.col(c).isNotNull()).select(digest(F.col(c)).alias("h")).distinct().withColumn("hit", F.lit(True))
    arm = lambda name, df, c, k: df.select("row_id", F.lit(name).alias("arm"), digest(c).alias("h")).join(known(k), "h", "left").select("row_id", "arm", F.col("hit").isNotNull().alias("hit"))
    o, i = r.where("output is not null"), r.where("instruction is not null")
    there = o.select(F.col("node_id").alias("parent_id")).distinct().withColumn("hit", F.lit(True))
    replies = r.where(F.col("parent_id").isNotNull() & ~F.endswith("parent_id", F.lit("[root]"))).join(there, "parent_id", "left").select("row_id", F.lit("reply_pair").alias("arm"), F.col("hit").isNotNull().alias("hit"))
    title = arm("title", i, F.regexp_extract("instruction", r"^\[POST-TITLE\] ?(.*)", 1), "post_title_clean")
    return title.unionByName(arm("output", o, F.col("output"), "text")).unionByName(arm("comment", o, text.reply_parts(F.col("output"))["body"], "text")).unionByName(replies)


@query("source_alignment_arms", _ARMS_SQL + "SELECT arm, count(*) AS rows, count(*) FILTER (hit) AS matched, round(count(*) FILTER (hit) / count(*), 6) AS rate FROM a GROUP BY arm")
def source_alignment_arms(s, d):
    return _arms(s, d).groupBy("arm").agg(F.count("*").alias("rows"), F.count_if("hit").alias("matched"), F.round(F.count_if("hit") / F.count("*"), 6).alias("rate"))


@query("alignment_mismatches", _ARMS_SQL + "SELECT row_id, arm FROM a WHERE NOT hit ORDER BY row_id, arm LIMIT 20")
def alignment_mismatches(s, d):
    """The first 20 rows that have no counterpart (a report of 20)."""
    return _arms(s, d).where("not hit").select("row_id", "arm").orderBy("row_id", "arm").limit(20)


@query("persona_pairs", """
WITH c AS (SELECT id, name, list_distinct(string_split(coalesce(trait, '') || coalesce(name, ''), '')) AS s FROM persona_list)
SELECT a.id AS a, b.id AS b, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) AS jaccard,
 CASE WHEN round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) < 0.4 THEN 'DISTINCT' WHEN round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))), 6) < 0.7 THEN 'SIMILAR' ELSE 'SAME' END AS verdict FROM c a JOIN c b ON a.id < b.id""")
def persona_pairs(s, d):
    """Pairs of the fixed 30 personas by the characters of their description, with a verdict."""
    p = table(s, d, "persona_list", "id", "name", "trait").select("id", F.array_distinct(F.split(F.concat(F.coalesce("trait", F.lit("")), F.coalesce("name", F.lit(""))), "")).alias("s"))
    q = F.broadcast(p.toDF("b", "t"))  # 30 rows, fixed
    j = F.round(F.size(F.array_intersect("s", "t")) / F.size(F.array_union("s", "t")), 6)
    x = p.withColumnRenamed("id", "a").join(q, F.col("a") < F.col("b")).withColumn("jaccard", j)
    return x.select("a", "b", "jaccard", F.when(F.col("jaccard") < 0.4, "DISTINCT").when(F.col("jaccard") < 0.7, "SIMILAR").otherwise("SAME").alias("verdict"))


@query("target_available", """
WITH a AS (SELECT kind, count(*) FILTER (split = 'train') AS machine, count(*) FILTER (split = 'eval') AS human FROM round2_build_tc_sft WHERE kind IS NOT NULL GROUP BY kind), k AS (SELECT kind, machine, human, row_number() OVER (ORDER BY kind) AS i, count(*) OVER () AS n FROM a WHERE machine > 0 AND human > 0)
SELECT kind, machine, human, CAST(150 // n + CASE WHEN i <= 150 % n THEN 1 ELSE 0 END AS BIGINT) AS target, CAST(least(150 // n + CASE WHEN i <= 150 % n THEN 1 ELSE 0 END, machine, human) AS BIGINT) AS available FROM k""")
def target_available(s, d):
    """Kinds both sides have, with an equal target for each and what both can give; one row per kind."""
    from pyspark.sql import Window

    a = table(s, d, T, "kind", "split").where("kind is not null").groupBy("kind").agg(F.count_if(F.col("split") == "train").alias("machine"), F.count_if(F.col("split") == "eval").alias("human")).where("machine > 0 and human > 0")
    k = a.withColumn("i", F.row_number().over(Window.orderBy("kind"))).withColumn("n", F.count("*").over(Window.partitionBy()))  # the kinds are a handful
    t = F.floor(F.lit(150) / F.col("n")) + (F.col("i") <= F.lit(150) % F.col("n")).cast("long")
    return k.select("kind", "machine", "human", t.alias("target"), F.least(t, "machine", "human").alias("available"))


QUERIES = Q
