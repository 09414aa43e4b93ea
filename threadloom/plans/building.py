"""Splits, sampling and example building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import packs, text
from ..operators import examples, filters, sampling
from ..session import table

Q: dict = {}
T = "round2_build_tc_sft"


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


_AD = "(?i)(?:" + packs.AD.replace(r"\s", r"[ \t\n\r\f\x0b]") + ")"


def sft(s: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(s, d, T, *cols)


@query("split_sha256_ab", "SELECT DISTINCT thread_key, CASE WHEN ('0x' || sha256(thread_key || ':42')[1:16])::UBIGINT % 2 = 0 THEN 'A' ELSE 'B' END AS side FROM documents WHERE thread_key IS NOT NULL")
def split_sha256_ab(s, d):
    t = table(s, d, "documents", "thread_key").where("thread_key is not null").distinct()
    return t.select("thread_key", sampling.split_ab(F.col("thread_key")).alias("side"))


@query("split_md5_thread", """
WITH v AS (SELECT DISTINCT source_id FROM valid WHERE source_id IS NOT NULL), h AS (SELECT DISTINCT thread_key, md5(thread_key) AS m FROM phase1_data_pipeline WHERE thread_key IS NOT NULL),
b AS (SELECT thread_key, CAST((((('0x' || m[1:16])::UBIGINT % 10000) * 1616 + ('0x' || m[17:32])::UBIGINT % 10000) % 10000) AS INTEGER) AS bucket FROM h)
SELECT thread_key, bucket, bucket < 500 OR thread_key IN (SELECT source_id FROM v) AS in_val FROM b""")
def split_md5_thread(s, d):
    """Threads by their digest, and those that hold validation rows already."""
    t = table(s, d, "phase1_data_pipeline", "thread_key").where("thread_key is not null").distinct()
    v = table(s, d, "valid", "source_id").where("source_id is not null").select(F.col("source_id").alias("thread_key")).distinct().withColumn("held", F.lit(True))
    b = text.md5_mod_10000(F.col("thread_key"))
    return t.join(v, "thread_key", "left").select("thread_key", b.alias("bucket"), ((b < 500) | F.col("held").isNotNull()).alias("in_val"))


@query("split_time_95_5", """
WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn, count(*) OVER () AS n FROM events)
SELECT CASE WHEN rn <= floor(n * 0.95) THEN 'train' ELSE 'val' END AS split, count(*) AS rows, min(event_id) AS first_id, max(event_id) AS last_id FROM r GROUP BY 1""")
def split_time_95_5(s, d):
    """Prefix split in arrival order (event ids rise with time), by distributed ranks."""
    e = table(s, d, "events", "event_id")
    n = e.agg(F.count("*").alias("n"))
    r = sampling.row_numbers(e, "event_id").join(F.broadcast(n))
    r = r.withColumn("split", F.when(F.col("rn") <= F.floor(F.col("n") * 0.95), "train").otherwise("val"))
    return r.groupBy("split").agg(F.count("*").alias("rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("split_undated_hash", "SELECT record_id, ('0x' || sha256(thread_key || ':42')[1:16])::UBIGINT % 1000 < 50 AS in_val FROM phase1_data_pipeline WHERE date IS NULL AND thread_key IS NOT NULL")
def split_undated_hash(s, d):
    t = table(s, d, "phase1_data_pipeline", "record_id", "thread_key", "date").where("date is null and thread_key is not null")
    return t.select("record_id", (text.hash64_mod(F.concat("thread_key", F.lit(":42")), 1000) < 50).alias("in_val"))


@query("split_every_10th", f"SELECT row_id, CASE WHEN (row_number() OVER (ORDER BY row_id) - 1) % 10 = 0 THEN 'eval' ELSE 'train' END AS new_split FROM {T}")
def split_every_10th(s, d):
    return sampling.every_nth(sft(s, d, "row_id"), "row_id").select("row_id", F.col("split").alias("new_split"))


_W = "CASE WHEN length(output) >= 200 THEN 2.0 ELSE 1.0 END * CASE WHEN regexp_matches(output, '[0-9]') THEN 1.5 ELSE 1.0 END"


@query("oversample_weighted", f"""
WITH w AS (SELECT row_id, least(greatest({_W}, 1.0), 10.0) AS w, ('0x' || sha256(CAST(row_id AS VARCHAR) || ':13')[1:16])::UBIGINT % 1000000 / 1e6 AS u FROM {T} WHERE output IS NOT NULL)
SELECT row_id, CAST(c AS INTEGER) AS copy FROM (SELECT row_id, unnest(range(1, CAST(floor(w) AS INTEGER) + CASE WHEN u < w - floor(w) THEN 1 ELSE 0 END + 1)) AS c FROM w)""")
def oversample_weighted(s, d):
    t = sft(s, d, "row_id", "output").where("output is not null")
    w = F.when(F.length("output") >= 200, 2.0).otherwise(1.0) * F.when(F.col("output").rlike("[0-9]"), 1.5).otherwise(1.0)
    return sampling.oversample(t, w, F.col("row_id").cast("string")).select("row_id", "copy")


@query("expansion_compare", f"""
WITH w AS (SELECT {_W} AS w FROM {T} WHERE output IS NOT NULL) SELECT w AS weight, count(*) AS rows, CAST(sum(round_even(w, 0)) AS BIGINT) AS rounded, round(sum(w), 6) AS expected FROM w GROUP BY w""")
def expansion_compare(s, d):
    t = sft(s, d, "output").where("output is not null")
    w = F.when(F.length("output") >= 200, 2.0).otherwise(1.0) * F.when(F.col("output").rlike("[0-9]"), 1.5).otherwise(1.0)
    return t.groupBy(w.alias("weight")).agg(F.count("*").alias("rows"), F.sum(F.bround(w)).cast("long").alias("rounded"), F.round(F.sum(w), 6).alias("expected"))


@query("mix_ratio_sample", """
WITH n AS (SELECT CAST(round_even(count(*) * 0.2 / 0.8, 0) AS BIGINT) AS take FROM documents)
SELECT valid_id FROM (SELECT valid_id, row_number() OVER (ORDER BY sha1(CAST(valid_id AS VARCHAR) || '|mix'), valid_id) AS rn FROM valid), n WHERE rn <= take""")
def mix_ratio_sample(s, d):
    """Pairs to mix into a raw corpus at a ratio of 0.8, in hash order (a sampling operator)."""
    n = table(s, d, "documents", "doc_id").count()
    h = F.concat_ws("|", F.sha1(F.concat(F.col("valid_id").cast("string"), F.lit("|mix"))), F.col("valid_id").cast("string"))
    return sampling.first_share(table(s, d, "valid", "valid_id").withColumn("h", h), "h", round(n * 0.2 / 0.8)).select("valid_id")


@query("quota_largest_remainder", """
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source), t AS (SELECT source, n, 500 * n / sum(n) OVER () AS x FROM c), f AS (SELECT source, n, CAST(floor(x) AS BIGINT) AS b, x - floor(x) AS r FROM t),
k AS (SELECT source, n, b, row_number() OVER (ORDER BY r DESC, source) AS rn, 500 - sum(b) OVER () AS spare FROM f)
SELECT source, n AS available, b + CASE WHEN rn <= spare THEN 1 ELSE 0 END AS quota FROM k""")
def quota_largest_remainder(s, d):
    c = {r.source: r.n for r in table(s, d, "documents", "source").groupBy("source").agg(F.count("*").alias("n")).collect()}  # one row per source
    q = sampling.largest_remainder(c, min(500, sum(c.values())), c)
    return s.createDataFrame([(k, c[k], q[k]) for k in sorted(c)], "source string, available long, quota long")


@query("bucket_quota", """
WITH c AS (SELECT length_bucket AS bucket, count(*) AS n FROM documents WHERE length_bucket IS NOT NULL GROUP BY 1), t AS (SELECT bucket, n, least(300, sum(n) OVER ()) * n / sum(n) OVER () AS x, least(300, sum(n) OVER ()) AS total FROM c), f AS (SELECT *, CAST(floor(x) AS BIGINT) AS b, x - floor(x) AS r FROM t),
k AS (SELECT bucket, n, b, row_number() OVER (ORDER BY r DESC, bucket) AS rn, total - sum(b) OVER () AS spare FROM f)
SELECT bucket, n AS available, CAST(b + CASE WHEN rn <= spare THEN 1 ELSE 0 END AS BIGINT) AS quota FROM k""")
def bucket_quota(s, d):
    c = {r.length_bucket: r.n for r in table(s, d, "documents", "length_bucket").where("length_bucket is not null").groupBy("length_bucket").agg(F.count("*").alias("n")).collect()}  # one row per bucket
    q = sampling.largest_remainder(c, min(300, sum(c.values())), c)
    return s.createDataFrame([(k, c[k], q[k]) for k in sorted(c)], "bucket string, available long, quota long")


@query("greedy_quota_selection", None)
def greedy_quota_selection(s, d):
    """Rows per kind by quotas over length buckets, at most 4 of a source over all buckets."""
    t = sft(s, d, "row_id", "kind", "root_id", "output").where("output is not null and kind is not null").select("row_id", "kind", text.bucket_b(F.col("output")).alias("bucket"), F.col("root_id").alias("source"))
    return sampling.greedy_quota(t, "kind", "bucket", "source", F.sha1(F.col("row_id").cast("string")), {"comment": 200, "reply": 120, "post": 80}, 4).select("row_id", "kind", "bucket")


@query("paired_sample", """
WITH a AS (SELECT kind, count(*) FILTER (split = 'train') AS x, count(*) FILTER (split = 'eval') AS y FROM round2_build_tc_sft WHERE kind IS NOT NULL GROUP BY kind), k AS (SELECT kind, least(x, y) AS room, row_number() OVER (ORDER BY kind) AS i, count(*) OVER () AS n FROM a WHERE x > 0 AND y > 0),
q AS (SELECT kind, CASE WHEN n = 1 THEN least(60, room) ELSE least(60 // n + CASE WHEN i <= 60 % n THEN 1 ELSE 0 END, room) END AS quota FROM k),
r AS (SELECT row_id, kind, split, row_number() OVER (PARTITION BY kind, split ORDER BY sha1(CAST(row_id AS VARCHAR)), row_id) AS rn FROM round2_build_tc_sft)
SELECT r.row_id, r.kind, r.split FROM r JOIN q USING (kind) WHERE rn <= quota AND split IN ('train', 'eval')""")
def paired_sample(s, d):
    """As many rows of every kind from both splits; kinds that lack rows are made up for, one by one, by the others."""
    t = sft(s, d, "row_id", "kind", "split").where("kind is not null")
    n = t.groupBy("kind").agg(F.count_if(F.col("split") == "train").alias("x"), F.count_if(F.col("split") == "eval").alias("y")).collect()  # one row per kind
    room = {r.kind: min(r.x, r.y) for r in n if r.x and r.y}
    quotas = sampling.round_robin(sampling.equal_targets(list(room), 60), room, 60)
    rank = F.struct(F.sha1(F.col("row_id").cast("string")), "row_id")
    return sampling.take(t.where("split = 'train'"), "kind", rank, quotas).unionByName(sampling.take(t.where("split = 'eval'"), "kind", rank, quotas))


_MIX = {"ko": 0.33, "en": 0.33, "es": 0.17, "fr": 0.17}


@query("class_mix", """
WITH c AS (SELECT lang, count(*) AS n FROM documents WHERE lang IN ('ko', 'en', 'es', 'fr') GROUP BY lang), q(lang, target) AS (VALUES ('ko', 13), ('en', 13), ('es', 7), ('fr', 7)),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha1(CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents WHERE lang IN ('ko', 'en', 'es', 'fr')), m AS (SELECT r.doc_id, r.lang FROM r JOIN q USING (lang) WHERE rn <= target)
SELECT doc_id, lang, CASE WHEN h < 80 THEN 'train' WHEN h < 90 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, ('0x' || sha256(CAST(doc_id AS VARCHAR) || ':mix')[1:16])::UBIGINT % 100 AS h FROM m)""")
def class_mix(s, d):
    """40 texts of four classes by shares, missing ones made up for by the others, with a hash split of 80/10/10."""
    t = table(s, d, "documents", "doc_id", "lang").where(F.col("lang").isin(list(_MIX)))
    have = {r.lang: r.n for r in t.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per class
    quotas = sampling.largest_remainder(_MIX, 40, have)
    h = text.hash64_mod(F.concat(F.col("doc_id").cast("string"), F.lit(":mix")), 100)
    rank = F.struct(F.sha1(F.col("doc_id").cast("string")), "doc_id")
    return sampling.take(t, "lang", rank, quotas).withColumn("split", F.when(h < 80, "train").when(h < 90, "validation").otherwise("test"))


@query("job_mix", """
WITH r AS (SELECT record_id, kind, row_number() OVER (PARTITION BY kind ORDER BY sha1(CAST(record_id AS VARCHAR)), record_id) AS rn, count(*) OVER (PARTITION BY kind) AS n FROM phase1_data_pipeline WHERE kind IN ('post', 'comment')),
q AS (SELECT least((SELECT count(*) FROM r WHERE kind = 'post'), greatest(1, 50)) AS posts)
SELECT record_id, kind FROM r, q WHERE rn <= CASE kind WHEN 'post' THEN posts ELSE 100 - posts END""")
def job_mix(s, d):
    """100 jobs, half of them posts as far as there are any; the other kind makes up for what is missing."""
    t = table(s, d, "phase1_data_pipeline", "record_id", "kind").where(F.col("kind").isin("post", "comment"))
    have = {r.kind: r.n for r in t.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # two rows
    quotas = sampling.round_robin({"post": 50, "comment": 50}, have, 100)
    return sampling.take(t, "kind", F.struct(F.sha1(F.col("record_id").cast("string")), "record_id"), quotas)


@query("first_rows", "SELECT row_id, instruction FROM round2_build_tc_sft ORDER BY row_id LIMIT 100")
def first_rows(s, d):
    """A cap on the rows of a run: the first 100 by id (the feature)."""
    return sft(s, d, "row_id", "instruction").orderBy("row_id").limit(100)


@query("capped_per_source", f"""
SELECT row_id, source FROM (SELECT row_id, source, row_number() OVER (PARTITION BY source ORDER BY sha1(CAST(row_id AS VARCHAR)), row_id) AS rn FROM {T}) WHERE source IS NULL OR rn <= 40""")
def capped_per_source(s, d):
    t = sft(s, d, "row_id", "source")
    return sampling.capped(t, "source", F.struct(F.sha1(F.col("row_id").cast("string")), "row_id"), 40).select("row_id", "source")


@query("stratified_sample", """
SELECT doc_id, kind, length_bucket FROM (SELECT doc_id, kind, length_bucket, row_number() OVER (PARTITION BY kind, length_bucket ORDER BY sha1(CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents) WHERE rn <= 10""")
def stratified_sample(s, d):
    t = table(s, d, "documents", "doc_id", "kind", "length_bucket")
    return sampling.stratified(t, ["kind", "length_bucket"], F.struct(F.sha1(F.col("doc_id").cast("string")), "doc_id"), 10).select("doc_id", "kind", "length_bucket")


# B: examples


@query("sft_pairs_v3", r"""
WITH o AS (SELECT node_id, max_by(output, row_id) AS parent FROM round2_build_tc_sft WHERE output IS NOT NULL GROUP BY node_id),
x AS (SELECT r.*, trim(regexp_extract(instruction, '(?s)\n\[POST-BODY\] ?(.*)$', 1)) AS b, regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1) AS k FROM round2_build_tc_sft r WHERE output IS NOT NULL)
SELECT row_id, regexp_extract(instruction, '^\[POST-TITLE\] ?(.*)', 1) AS post_title, CASE WHEN length(b) > 256 THEN rtrim(b[1:256]) || '...' ELSE b END AS post_body_excerpt, coalesce(o.parent, '') AS parent_comment,
 regexp_replace(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\][ \t\n\r\f\x0b]*', '') AS target_comment, CASE WHEN k = '' THEN 0 ELSE CAST(len(string_split(k, '-')) AS INTEGER) END AS depth
FROM x LEFT JOIN o ON o.node_id = x.parent_id""")
def sft_pairs_v3(s, d):
    return examples.thread_pairs(sft(s, d, "row_id", "instruction", "output", "node_id", "parent_id"))


@query("continuation_rows", f"""
WITH p AS (SELECT record_id, source_id, thread_key, trim(text) AS target FROM phase1_data_pipeline WHERE kind = 'post' AND trim(text) <> '' AND NOT regexp_matches(text, '{_AD}'))
SELECT record_id, coalesce(source_id, thread_key) AS thread_key, 'post_continuation' AS task_type, 0 AS depth, CASE WHEN length(target) > 256 THEN rtrim(target[1:256]) || '...' ELSE target END AS post_body_excerpt, target AS target_comment,
 CASE WHEN length(target) < 40 THEN 'xs' WHEN length(target) < 80 THEN 'sm' WHEN length(target) < 160 THEN 'md' ELSE 'lg' END AS length_bucket FROM p""")
def continuation_rows(s, d):
    """Posts as rows that continue themselves, at depth 0."""
    p = table(s, d, "phase1_data_pipeline", "record_id", "kind", "source_id", "thread_key", "text").where((F.col("kind") == "post") & (F.trim("text") != "") & ~F.col("text").rlike("(?i)(?:" + packs.AD + ")"))
    t = F.trim("text")
    return p.select("record_id", F.coalesce("source_id", "thread_key").alias("thread_key"), F.lit("post_continuation").alias("task_type"), F.lit(0).alias("depth"), text.excerpt(F.col("text")).alias("post_body_excerpt"), t.alias("target_comment"), text.bucket_b(F.col("text")).alias("length_bucket"))


@query("thread_tasks", r"""
WITH c AS (SELECT row_id, output, regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1) AS k, regexp_replace(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\][ \t\n\r\f\x0b]*', '') AS body FROM round2_build_tc_sft WHERE output IS NOT NULL),
r AS (SELECT CASE WHEN contains(k, '-') THEN 'reply' ELSE 'root_comment' END AS task_type, CASE WHEN regexp_matches(output, '@BLOCKED@') THEN 'placeholder' WHEN regexp_matches(body, '@AD@') THEN 'ad' WHEN regexp_replace(body, '@WS@+', '', 'g') = '' THEN 'empty' END AS reason FROM c)
SELECT task_type, coalesce(reason, 'kept') AS outcome, count(*) AS rows FROM r GROUP BY 1, 2""".replace("@BLOCKED@", packs.BLOCKED.replace(r"\s", r"[ \t\n\r\f\x0b]")).replace("@AD@", _AD).replace("@WS@", text.WS))
def thread_tasks(s, d):
    """Task types of the rows, and why rows fall, the first reason first."""
    t = sft(s, d, "output").where("output is not null")
    r = text.reply_parts(F.col("output"))
    reason = filters.first_reason([("placeholder", F.col("output").rlike(packs.BLOCKED)), ("ad", r["body"].rlike("(?i)(?:" + packs.AD + ")")), ("empty", text.strip(r["body"]) == "")])
    return t.groupBy(F.when(r["segments"] > 1, "reply").otherwise("root_comment").alias("task_type"), F.coalesce(reason, F.lit("kept")).alias("outcome")).agg(F.count("*").alias("rows"))


@query("thread_conditioned_rows", f"""
WITH p AS (SELECT name, tone, mood, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n FROM persona_list), o AS (SELECT node_id, max_by(output, row_id) AS parent FROM {T} WHERE output IS NOT NULL GROUP BY node_id),
h AS (SELECT *, ('0x' || sha256(CAST(row_id AS VARCHAR))[1:16])::UBIGINT AS h FROM {T} WHERE output IS NOT NULL)
SELECT h.row_id, h.instruction, '[CONTEXT]' || chr(10) || coalesce(o.parent, '(no parent)') || chr(10) || '[REPLY-DEPTH=' || coalesce(CAST(h.depth AS VARCHAR), '1') || ']' || chr(10) || '[PERSONA: ' || concat_ws(' | ', p.name, p.tone, p.mood) || ']' AS input, h.output,
 CASE WHEN len(list_distinct(list_concat(regexp_extract_all(coalesce(h.instruction, ''), '{'|'.join(packs.TERMS)}'), regexp_extract_all(h.output, '{'|'.join(packs.TERMS)}')))) >= 2 THEN 1.5 ELSE 1.0 END::DOUBLE AS loss_weight
FROM h LEFT JOIN o ON o.node_id = h.parent_id JOIN p ON p.i = h.h % p.n""")
def thread_conditioned_rows(s, d):
    """Reply rows with their context, depth, a persona by hash and the weight of their terms."""
    people = table(s, d, "persona_list", "id", "name", "tone", "mood").orderBy("id").collect()  # the fixed persona list
    i = text.hash64_mod(F.col("row_id").cast("string"), len(people))
    persona = F.element_at(F.array(*[F.lit(" | ".join(x for x in (p.name, p.tone, p.mood) if x is not None)) for p in people]), i + 1)
    t = sft(s, d, "row_id", "instruction", "output", "node_id", "parent_id", "depth").where("output is not null")
    o = t.groupBy(F.col("node_id").alias("parent_id")).agg(F.max_by("output", "row_id").alias("parent"))
    line = F.concat(F.lit("[CONTEXT]\n"), F.coalesce("parent", F.lit("(no parent)")), F.lit("\n[REPLY-DEPTH="), F.coalesce(F.col("depth").cast("string"), F.lit("1")), F.lit("]\n[PERSONA: "), persona, F.lit("]"))
    return t.join(o, "parent_id", "left").select("row_id", "instruction", line.alias("input"), "output", text.loss_weight([F.col("instruction"), F.col("output")], packs.TERMS).alias("loss_weight"))


@query("chat_messages", f"""
SELECT row_id, '[{{"role":"user","content":' || to_json(instruction) || '}},{{"role":"assistant","content":' || to_json(output) || '}}]' AS messages FROM {T} WHERE output IS NOT NULL""")
def chat_messages(s, d):
    t = sft(s, d, "row_id", "instruction", "output").where("output is not null")
    return t.select("row_id", F.to_json(examples.messages(None, F.col("instruction"), F.col("output"))).alias("messages"))


@query("prompt_reference_task", f"SELECT row_id, concat_ws(chr(10), instruction, nullif(trim(input), ''), '### 답변') AS prompt FROM {T}")
def prompt_reference_task(s, d):
    t = sft(s, d, "row_id", "instruction", "input")
    return t.select("row_id", F.concat_ws("\n", "instruction", F.nullif(F.trim("input"), F.lit("")), F.lit("### 답변")).alias("prompt"))


_WORDS = f"[^{text.WS[1:]}+"


def _ids(c: str) -> str:
    return f"list_transform(regexp_extract_all({c}, '{_WORDS}'), lambda w: CAST(('0x' || md5(w)[1:4])::INTEGER % 32768 AS INTEGER))"


@query("masked_labels", f"""
WITH t AS (SELECT row_id, {_ids('instruction')} AS p, {_ids('output')} AS a FROM {T} WHERE output IS NOT NULL), x AS (SELECT row_id, list_concat(p, a)[1:1024] AS input_ids, list_concat(list_transform(p, lambda i: -100), a)[1:1024] AS labels FROM t)
SELECT row_id, input_ids, list_transform(input_ids, lambda i: 1) AS attention_mask, labels, len(list_filter(labels, lambda i: i <> -100)) > 0 AS trainable FROM x""")
def masked_labels(s, d):
    """Supervised examples with ignored prompt labels, cut at 1024 ids; rows with nothing to learn are marked."""
    t = sft(s, d, "row_id", "instruction", "output").where("output is not null")
    t = t.select("row_id", examples.token_ids(F.col("instruction")).alias("p"), examples.token_ids(F.col("output")).alias("a"))
    e = examples.masked_example(F.col("p"), F.col("a"), 1024)
    return t.select("row_id", *[c.alias(k) for k, c in e.items()])


@query("raw_examples", f"SELECT doc_id, list_concat({_ids('text')}, [0])[1:1024] AS input_ids, list_concat({_ids('text')}, [0])[1:1024] AS labels FROM documents WHERE text IS NOT NULL")
def raw_examples(s, d):
    """Raw rows whose labels are their ids."""
    e = examples.raw_example(F.col("text"), 1024)
    return table(s, d, "documents", "doc_id", "text").where("text is not null").select("doc_id", e["input_ids"].alias("input_ids"), e["labels"].alias("labels"))


@query("chat_masks", f"""
WITH t AS (SELECT row_id, '<|im_start|>system' || chr(10) || 'system<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS head, output || '<|im_end|>' || chr(10) AS tail FROM {T} WHERE output IS NOT NULL AND instruction IS NOT NULL),
x AS (SELECT row_id, {_ids('head')} AS p, {_ids('head || tail')}[1:1024] AS ids FROM t)
SELECT row_id, len(ids) AS ids, greatest(len(ids) - least(len(p), len(ids)), 0) AS learned, len(ids) > len(p) AS trainable FROM x""")
def chat_masks(s, d):
    """Chat examples: how many ids there are, and how many after the last assistant mark are learned."""
    t = sft(s, d, "row_id", "instruction", "output").where("output is not null and instruction is not null")
    e = examples.chat_example(examples.chat_text("system", F.col("instruction"), F.col("output")), 1024)
    return t.select("row_id", F.size(e["input_ids"]).cast("long").alias("ids"), F.size(F.filter(e["labels"], lambda x: x != examples.IGNORE)).cast("long").alias("learned"), e["trainable"].alias("trainable"))


def _strip(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^{text.WS}+|{text.WS}+$', '', 'g')"


@query("schema_branches", f"""
WITH r AS (SELECT row_id, row_id % 2 = 0 AS paired, {_strip('instruction')} AS i, {_strip('input')} AS x, {_strip('output')} AS o, output FROM {T})
SELECT row_id, CASE WHEN paired THEN 'instruction' ELSE 'post' END AS branch, CASE WHEN i <> '' AND o <> '' THEN i || CASE WHEN paired AND x <> '' THEN chr(10) || x ELSE '' END || chr(10) END AS prompt, CASE WHEN i <> '' AND o <> '' THEN o END AS answer FROM r""")
def schema_branches(s, d):
    """Rows of two schemas (odd ones read as post and comment) brought to prompt and answer."""
    t, even = sft(s, d, "row_id", "instruction", "input", "output"), F.col("row_id") % 2 == 0
    none = F.lit(None).cast("string")
    only = lambda c, yes: F.when(yes, F.coalesce(F.col(c), F.lit(""))).otherwise(none)
    b = examples.prompt_and_answer(only("instruction", even), F.col("input"), only("output", even), only("instruction", ~even), only("output", ~even))
    return t.select("row_id", *[c.alias(k) for k, c in b.items()])


@query("preference_pairs_filled", f"""
WITH x AS (SELECT {_strip('text')} AS t FROM valid UNION SELECT {_strip('output')} FROM {T} WHERE split = 'eval'), r AS (SELECT * FROM {T} WHERE split = 'train' AND length(output) BETWEEN 8 AND 199),
c AS (SELECT output, row_number() OVER (ORDER BY sha1(CAST(row_id AS VARCHAR) || ':11'), row_id) AS pair FROM r WHERE regexp_matches(output, '[가-힣]') AND NOT regexp_matches(output, '(습니다|합니다)') AND {_strip('output')} NOT IN (SELECT t FROM x)),
b AS (SELECT output, row_number() OVER (ORDER BY sha1(CAST(row_id AS VARCHAR) || ':11'), row_id) AS pair FROM r WHERE regexp_matches(output, '(습니다|합니다)')),
j AS (SELECT c.pair, c.output AS chosen, b.output AS bad, ('0x' || sha256(CAST(c.pair AS VARCHAR))[1:16])::UBIGINT % 3 AS m FROM c LEFT JOIN b USING (pair))
SELECT pair, chosen, coalesce(bad, CASE m WHEN 0 THEN '다음과 같은 점을 안내드립니다. ' || chosen WHEN 1 THEN chosen || ' 참고만 해주세요' ELSE '다음과 같은 점을 안내드립니다. ' || chosen || ' 참고만 해주세요' END) AS rejected, bad IS NOT NULL AS mined FROM j WHERE pair <= 1500""")
def preference_pairs_filled(s, d):
    """Short casual training outputs outside the held-out texts against formal ones, filled up with synthetic negatives;
    1,500 pairs is the size of the data set built."""
    t = sft(s, d, "row_id", "split", "output")
    held = table(s, d, "valid", "text").select(F.col("text").alias("t")).unionByName(t.where("split = 'eval'").select(F.col("output").alias("t")))
    held = held.select(F.sha2(text.strip(F.coalesce("t", F.lit(""))), 256).alias("h")).distinct()
    formal = F.col("output").rlike("(습니다|합니다)")
    rows = t.where("split = 'train'").where(F.length("output").between(8, 199))
    return examples.mined_pairs(rows, "row_id", "output", held, F.col("output").rlike("[가-힣]") & ~formal, formal, 1500)


@query("preference_pairs", f"""
WITH c AS (SELECT output, row_number() OVER (ORDER BY sha1(CAST(row_id AS VARCHAR) || ':11'), row_id) AS pair FROM {T} WHERE length(output) >= 30 AND regexp_matches(output, 'ㅋㅋ|ㅎㅎ|ㅠㅠ')),
r AS (SELECT output, row_number() OVER (ORDER BY sha1(CAST(row_id AS VARCHAR) || ':11'), row_id) AS pair FROM {T} WHERE length(output) BETWEEN 15 AND 256 AND regexp_matches(output, '(습니다|합니다)') AND NOT regexp_matches(output, 'ㅋㅋ|ㅎㅎ|ㅠㅠ'))
SELECT c.pair, c.output AS chosen, r.output AS rejected FROM c JOIN r USING (pair)""")
def preference_pairs(s, d):
    t = sft(s, d, "row_id", "output")
    slang = F.col("output").rlike("ㅋㅋ|ㅎㅎ|ㅠㅠ")
    good = t.where((F.length("output") >= 30) & slang)
    bad = t.where(F.length("output").between(15, 256) & F.col("output").rlike("(습니다|합니다)") & ~slang)
    return examples.preference_pairs(good, bad, "row_id", "output")


_FULL = f"regexp_replace(coalesce({{c}}, ''), '^{text.WS.replace('{', '{{').replace('}', '}}')}+|{text.WS.replace('{', '{{').replace('}', '}}')}+$', '', 'g') <> ''"


@query("pair_validation", f"""
SELECT count(*) AS rows, count(*) FILTER ({_FULL.format(c='output')} AND {_FULL.format(c='instruction')}) AS complete, bool_and({_FULL.format(c='instruction')}) AS all_prompts FROM {T}""")
def pair_validation(s, d):
    full = lambda c: text.strip(F.coalesce(c, F.lit(""))) != ""
    return sft(s, d, "instruction", "output").agg(F.count("*").alias("rows"), F.count_if(full("output") & full("instruction")).alias("complete"), F.bool_and(full("instruction")).alias("all_prompts"))


@query("synthetic_negatives", f"""
WITH m AS (SELECT row_id, output, ('0x' || sha256(CAST(row_id AS VARCHAR))[1:16])::UBIGINT % 3 AS m FROM {T} WHERE output IS NOT NULL)
SELECT row_id, CASE m WHEN 0 THEN '다음과 같은 점을 안내드립니다. ' || output WHEN 1 THEN output || ' 참고만 해주세요' ELSE '다음과 같은 점을 안내드립니다. ' || output || ' 참고만 해주세요' END AS rejected FROM m""")
def synthetic_negatives(s, d):
    t = sft(s, d, "row_id", "output").where("output is not null")
    return t.select("row_id", examples.synthetic_negative(F.col("output"), F.col("row_id").cast("string")).alias("rejected"))


@query("structural_markup", f"""SELECT row_id, '<post>' || instruction || '</post>' || chr(10) || '<comment depth=' || depth || '>' || output || '</comment>' AS doc FROM {T} WHERE output IS NOT NULL AND depth IS NOT NULL""")
def structural_markup(s, d):
    t = sft(s, d, "row_id", "instruction", "depth", "output").where("output is not null and depth is not null")
    return t.select("row_id", F.concat(F.lit("<post>"), "instruction", F.lit("</post>\n<comment depth="), F.col("depth").cast("string"), F.lit(">"), "output", F.lit("</comment>")).alias("doc"))


@query("persona_assignment", f"""
WITH p AS (SELECT name, row_number() OVER (ORDER BY id) - 1 AS i, count(*) OVER () AS n FROM persona_list), h AS (SELECT row_id, ('0x' || sha256(CAST(row_id AS VARCHAR))[1:16])::UBIGINT AS h FROM {T})
SELECT row_id, name AS persona FROM h, p WHERE p.i = h.h % p.n""")
def persona_assignment(s, d):
    names = [r.name for r in table(s, d, "persona_list", "id", "name").orderBy("id").collect()]  # the fixed persona list
    i = text.hash64_mod(F.col("row_id").cast("string"), len(names))
    return sft(s, d, "row_id").select("row_id", F.element_at(F.array(*[F.lit(n) for n in names]), i + 1).alias("persona"))


QUERIES = Q
