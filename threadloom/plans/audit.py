"""Aggregations, quantiles, vocabulary, distribution metrics and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import packs, text
from ..operators import metrics, quantiles, sampling
from ..session import spread, table

Q: dict = {}
TERMS = packs.TERMS


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def docs(s: SparkSession, d: str, *extra: str) -> DataFrame:
    return table(s, d, "documents", "doc_id", "text", *extra)


# A: aggregations


@query("group_counts_sets", "SELECT kind, length_bucket, count(*) AS n FROM documents GROUP BY GROUPING SETS ((kind, length_bucket), (kind), ())")
def group_counts_sets(s, d):
    t = table(s, d, "documents", "kind", "length_bucket")
    return t.groupingSets([("kind", "length_bucket"), ("kind",), ()], "kind", "length_bucket").agg(F.count("*").alias("n"))


@query("share_by_source", "SELECT source, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM documents GROUP BY source")
def share_by_source(s, d):
    g = table(s, d, "documents", "source").groupBy("source").agg(F.count("*").alias("n"))
    return g.join(F.broadcast(g.agg(F.sum("n").alias("all")))).select("source", "n", F.round(F.col("n") / F.col("all"), 4).alias("share"))


@query("month_counts", "SELECT strftime(date, '%Y-%m') AS month, count(*) AS n FROM documents WHERE date IS NOT NULL GROUP BY 1")
def month_counts(s, d):
    return table(s, d, "documents", "date").where("date is not null").groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("marker_rates", r"""
SELECT board, count(*) AS rows, round(avg(CASE WHEN regexp_matches(text, '\?') THEN 1 ELSE 0 END), 6) AS question, round(avg(CASE WHEN regexp_matches(text, '!') THEN 1 ELSE 0 END), 6) AS exclaim,
 round(avg(CASE WHEN regexp_matches(text, '\.\.') THEN 1 ELSE 0 END), 6) AS dots, round(avg(CASE WHEN regexp_matches(text, 'ㅋㅋ|ㅎㅎ') THEN 1 ELSE 0 END), 6) AS laugh, round(avg(CASE WHEN regexp_matches(text, 'ㅠ|ㅜ') THEN 1 ELSE 0 END), 6) AS cry,
 round(avg(CASE WHEN length(text) <= 12 THEN 1 ELSE 0 END), 6) AS tiny FROM valid GROUP BY board""")
def marker_rates(s, d):
    c = F.col("text")
    marks = {"question": c.rlike(r"\?"), "exclaim": c.rlike("!"), "dots": c.rlike(r"\.\."), "laugh": c.rlike("ㅋㅋ|ㅎㅎ"), "cry": c.rlike("ㅠ|ㅜ"), "tiny": F.length(c) <= 12}
    return table(s, d, "valid", "board", "text").groupBy("board").agg(F.count("*").alias("rows"), *[F.round(F.avg(m.cast("int")), 6).alias(k) for k, m in marks.items()])


@query("topk_tokens", """
WITH t AS (SELECT unnest(regexp_extract_all(text, '[가-힣A-Za-z0-9]{2,}')) AS token FROM valid)
SELECT token, count(*) AS n FROM t WHERE token NOT IN ('진짜', '그냥', '지금', '근데') GROUP BY token ORDER BY n DESC, token LIMIT 50""")
def topk_tokens(s, d):
    t = table(s, d, "valid", "text").select(F.explode(F.regexp_extract_all("text", F.lit("([가-힣A-Za-z0-9]{2,})"), F.lit(1))).alias("token"))
    return t.where(~F.col("token").isin("진짜", "그냥", "지금", "근데")).groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(50)


@query("author_index", """
SELECT author, count(*) AS rows, count(*) FILTER (kind = 'post') AS posts, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)), 6) AS mean_chars, count(*) >= 3 AS veteran FROM valid WHERE author IS NOT NULL GROUP BY author""")
def author_index(s, d):
    n = F.length("text")
    return table(s, d, "valid", "author", "kind", "text").where("author is not null").groupBy("author").agg(F.count("*").alias("rows"), F.count_if(F.col("kind") == "post").alias("posts"), F.sum(n.cast("long")).alias("chars"), F.round(F.avg(n), 6).alias("mean_chars"), (F.count("*") >= 3).alias("veteran"))


@query("key_frequency", "SELECT k AS key, count(*) AS rows FROM (SELECT unnest(json_keys(props)) AS k FROM events WHERE props IS NOT NULL) GROUP BY k")
def key_frequency(s, d):
    return table(s, d, "events", "props").select(F.explode(F.json_object_keys("props")).alias("key")).groupBy("key").agg(F.count("*").alias("rows"))


@query("distinct_threads_authors", "SELECT count(DISTINCT thread_key) AS threads, count(DISTINCT author_key) AS authors FROM phase1_data_pipeline")
def distinct_threads_authors(s, d):
    return table(s, d, "phase1_data_pipeline", "thread_key", "author_key").agg(F.count_distinct("thread_key").alias("threads"), F.count_distinct("author_key").alias("authors"))


_VOCAB = """SELECT token AS term FROM (SELECT unnest(regexp_extract_all(text, '[가-힣A-Za-z0-9]{2,}')) AS token FROM valid) GROUP BY token ORDER BY count(*) DESC, token LIMIT 240"""


@query("term_fire_audit", f"""
WITH t AS ({_VOCAB}), o AS (SELECT term, CAST((length(text) - length(replace(text, term, ''))) / length(term) AS BIGINT) AS k FROM documents, t WHERE text IS NOT NULL)
SELECT term, CAST(sum(k) AS BIGINT) AS fires, count(*) FILTER (k > 0) AS rows_with, round(count(*) FILTER (k > 0) / (SELECT count(*) FROM documents), 6) AS rate, sum(k) = 0 AS dead FROM o GROUP BY term""")
def term_fire_audit(s, d):
    """Fires of the 240 most frequent tokens of valid in documents, and which are dead: one pass over the texts."""
    t = table(s, d, "valid", "text").select(F.explode(F.regexp_extract_all("text", F.lit("([가-힣A-Za-z0-9]{2,})"), F.lit(1))).alias("term"))
    terms = [r.term for r in t.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(240).collect()]  # a vocabulary of 240
    t = metrics.term_fires(spread(docs(s, d)), "text", terms)
    return t.select("term", "fires", "rows_with", F.round(F.col("rows_with") / F.col("rows"), 6).alias("rate"), (F.col("fires") == 0).alias("dead"))


@query("dimension_baseline", """
SELECT CASE WHEN regexp_matches(trim(text), '(\\?)$') THEN 'question' WHEN regexp_matches(trim(text), '(ㅋ|ㅎ)$') THEN 'laugh' WHEN regexp_matches(trim(text), '(ㅠ|ㅜ)$') THEN 'sad' ELSE 'plain' END AS ending, count(*) AS n FROM documents GROUP BY 1""")
def dimension_baseline(s, d):
    t = F.trim("text")
    e = F.when(t.endswith("?"), "question").when(t.endswith("ㅋ") | t.endswith("ㅎ"), "laugh").when(t.endswith("ㅠ") | t.endswith("ㅜ"), "sad").otherwise("plain")
    return docs(s, d).groupBy(e.alias("ending")).agg(F.count("*").alias("n"))


@query("confusion_matrix", """
WITH p AS (SELECT l.abusive AS truth, CASE WHEN regexp_matches(v.text, '씨발|시발|병신|꺼져|쓰레기|극혐') THEN 1 ELSE 0 END AS predicted FROM valid v JOIN valid_labels l USING (valid_id))
SELECT count(*) FILTER (truth = 1 AND predicted = 1) AS tp, count(*) FILTER (truth = 0 AND predicted = 1) AS fp, count(*) FILTER (truth = 1 AND predicted = 0) AS fn, count(*) FILTER (truth = 0 AND predicted = 0) AS tn, round(avg(CASE WHEN truth = predicted THEN 1 ELSE 0 END), 6) AS accuracy FROM p""")
def confusion_matrix(s, d):
    v = table(s, d, "valid", "valid_id", "text").join(table(s, d, "valid_labels", "valid_id", "abusive"), "valid_id")
    v = v.select(F.col("abusive").alias("t"), F.col("text").rlike("씨발|시발|병신|꺼져|쓰레기|극혐").cast("int").alias("p"))
    c = lambda a, b: F.count_if((F.col("t") == a) & (F.col("p") == b))
    return v.agg(c(1, 1).alias("tp"), c(0, 1).alias("fp"), c(1, 0).alias("fn"), c(0, 0).alias("tn"), F.round(F.avg((F.col("t") == F.col("p")).cast("int")), 6).alias("accuracy"))


@query("judge_consensus", """
WITH j AS (SELECT valid_id, CASE WHEN length(text) > 100 THEN 1 ELSE 0 END + CASE WHEN regexp_matches(text, '(습니다|입니다)') THEN 1 ELSE 0 END + CASE WHEN NOT regexp_matches(text, 'ㅋ|ㅎ|ㅠ') THEN 1 ELSE 0 END AS votes FROM valid)
SELECT CASE WHEN votes >= 2 THEN 'AI' ELSE 'HUMAN' END AS label, count(*) AS n, count(*) FILTER (votes IN (1, 2)) AS split_votes FROM j GROUP BY 1""")
def judge_consensus(s, d):
    """Majority of three rule judges, one row per judge and sample, counted per sample."""
    v = table(s, d, "valid", "valid_id", "text")
    c = F.col("text")
    votes = v.select("valid_id", F.explode(F.array((F.length(c) > 100).cast("int"), c.rlike("(습니다|입니다)").cast("int"), (~c.rlike("ㅋ|ㅎ|ㅠ")).cast("int"))).alias("ai"))
    per = votes.groupBy("valid_id").agg(F.sum("ai").alias("votes"))
    return per.groupBy(F.when(F.col("votes") >= 2, "AI").otherwise("HUMAN").alias("label")).agg(F.count("*").alias("n"), F.count_if(F.col("votes").isin(1, 2)).alias("split_votes"))


@query("wilson_ci", """
WITH a AS (SELECT reviewer, count(*) AS n, sum(abusive) AS k FROM valid_labels GROUP BY reviewer), p AS (SELECT reviewer, n, CAST(k AS BIGINT) AS hits, k / n AS p, 1.959964 AS z FROM a)
SELECT reviewer, n, hits, round((p + z*z/(2*n)) / (1 + z*z/n) - z * sqrt(p*(1-p)/n + z*z/(4*n*n)) / (1 + z*z/n), 6) AS low, round((p + z*z/(2*n)) / (1 + z*z/n) + z * sqrt(p*(1-p)/n + z*z/(4*n*n)) / (1 + z*z/n), 6) AS high FROM p""")
def wilson_ci(s, d):
    a = table(s, d, "valid_labels", "reviewer", "abusive").groupBy("reviewer").agg(F.count("*").alias("n"), F.sum(F.col("abusive").cast("long")).alias("hits"))
    low, high = metrics.wilson(F.col("hits"), F.col("n"))
    return a.select("reviewer", "n", "hits", low.alias("low"), high.alias("high"))


@query("strata_under_covered", "SELECT kind, length_bucket, lang, count(*) AS n FROM documents GROUP BY 1, 2, 3 HAVING count(*) < 20")
def strata_under_covered(s, d):
    return table(s, d, "documents", "kind", "length_bucket", "lang").groupBy("kind", "length_bucket", "lang").agg(F.count("*").alias("n")).where("n < 20")


@query("ab_z_test", """
WITH g AS (SELECT split, count(*) AS n, count(*) FILTER (length(output) >= 80) AS k FROM round2_build_tc_sft WHERE output IS NOT NULL GROUP BY split),
w AS (SELECT sum(n) FILTER (split = 'train') AS n1, sum(k) FILTER (split = 'train') AS k1, sum(n) FILTER (split = 'eval') AS n2, sum(k) FILTER (split = 'eval') AS k2 FROM g)
SELECT round((k1/n1 - k2/n2) / sqrt(((k1+k2)/(n1+n2)) * (1 - (k1+k2)/(n1+n2)) * (1/n1 + 1/n2)), 6) AS z, round(2*asin(sqrt(k1/n1)) - 2*asin(sqrt(k2/n2)), 6) AS cohens_h FROM w""")
def ab_z_test(s, d):
    t = table(s, d, "round2_build_tc_sft", "split", "output").where("output is not null")
    n = lambda x: F.count_if(F.col("split") == x).cast("double")
    k = lambda x: F.count_if((F.col("split") == x) & (F.length("output") >= 80)).cast("double")
    w = t.agg(n("train").alias("n1"), k("train").alias("k1"), n("eval").alias("n2"), k("eval").alias("k2"))
    z = "(k1/n1 - k2/n2) / sqrt(((k1+k2)/(n1+n2)) * (1 - (k1+k2)/(n1+n2)) * (1/n1 + 1/n2))"
    return w.select(F.round(F.expr(z), 6).alias("z"), F.round(F.expr("2*asin(sqrt(k1/n1)) - 2*asin(sqrt(k2/n2))"), 6).alias("cohens_h"))


@query("auc_rank_sum", """
WITH s AS (SELECT l.abusive AS y, length(v.text) AS x FROM valid v JOIN valid_labels l USING (valid_id)), c AS (SELECT x, count(*) AS n, sum(y) AS p FROM s GROUP BY x),
r AS (SELECT *, sum(n) OVER (ORDER BY x) - n + (n + 1) / 2.0 AS rank FROM c)
SELECT round((sum(p * rank) - sum(p) * (sum(p) + 1) / 2.0) / (sum(p) * (sum(n) - sum(p))), 6) AS auc FROM r""")
def auc_rank_sum(s, d):
    v = table(s, d, "valid", "valid_id", "text").join(table(s, d, "valid_labels", "valid_id", "abusive"), "valid_id")
    c = v.groupBy(F.length("text").alias("x")).agg(F.count("*").alias("n"), F.sum("abusive").alias("p"))
    r = c.withColumn("rank", F.sum("n").over(Window.orderBy("x")) - F.col("n") + (F.col("n") + 1) / 2)  # one row per distinct length
    return r.agg(F.round((F.sum(F.col("p") * F.col("rank")) - F.sum("p") * (F.sum("p") + 1) / 2) / (F.sum("p") * (F.sum("n") - F.sum("p"))), 6).alias("auc"))


@query("side_lengths", "SELECT split, min(length(output)) AS shortest, median(length(output)) AS middle, round(avg(length(output)), 6) AS mean, max(length(output)) AS longest FROM round2_build_tc_sft WHERE output IS NOT NULL GROUP BY split")
def side_lengths(s, d):
    n = F.length("output")
    t = table(s, d, "round2_build_tc_sft", "split", "output").where("output is not null")
    return t.groupBy("split").agg(F.min(n).cast("long").alias("shortest"), F.median(n).alias("middle"), F.round(F.avg(n), 6).alias("mean"), F.max(n).cast("long").alias("longest"))


@query("fertility_pseudo", r"""
SELECT lang, round(avg(length(text) / greatest(1, len(regexp_extract_all(text, '[^ \t\n\r\f\x0b]+')))), 6) AS chars_per_token FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def fertility_pseudo(s, d):
    n = F.greatest(F.lit(1), text.count_of(F.col("text"), r"\S+"))
    return table(s, d, "documents", "lang", "text").where("lang is not null").groupBy("lang").agg(F.round(F.avg(F.length("text") / n), 6).alias("chars_per_token"))


@query("cost_estimate", """
WITH r AS (SELECT count(*) AS rows FROM round2_build_tc_sft), e AS (SELECT rows, CAST(ceil(rows / 16.0) * 2 AS BIGINT) AS steps FROM r)
SELECT rows, steps, round(steps * 18.43 / 3600, 6) AS hours, round(steps * 18.43 / 3600 * 0.79, 6) AS usd FROM e""")
def cost_estimate(s, d):
    e = table(s, d, "round2_build_tc_sft", "row_id").agg(F.count("*").alias("rows")).withColumn("steps", (F.ceil(F.col("rows") / 16) * 2).cast("long"))
    h = F.col("steps") * 18.43 / 3600
    return e.select("rows", "steps", F.round(h, 6).alias("hours"), F.round(h * 0.79, 6).alias("usd"))


# W: quantiles

_R = {"floor": "least(n, CAST(floor(n * {q}) AS BIGINT) + 1)", "nearest": "greatest(1, CAST(ceil(n * {q}) AS BIGINT))", "round": "CAST(round_even((n - 1) * {q}, 0) AS BIGINT) + 1"}


def _quantile(method: str):
    cols = ", ".join(f"min(CASE WHEN rn = {_R[method].format(q=q)} THEN v END) AS p{round(q * 100)}" for q in (0.5, 0.9, 0.99))
    sql = f"WITH o AS (SELECT length(text) AS v, row_number() OVER (ORDER BY length(text)) AS rn, count(*) OVER () AS n FROM documents) SELECT {cols} FROM o"

    @query(f"percentiles_{method}", sql)
    def run(s, d, method=method):
        return quantiles.percentiles(docs(s, d), F.length("text").cast("long"), [0.5, 0.9, 0.99], method)

    return run


for _m in _R:
    _quantile(_m)


@query("stagnation_lag", """
WITH w AS (SELECT date_trunc('day', ts) AS day, round(avg(value), 6) AS v FROM events GROUP BY 1)
SELECT day, v, abs(v - lag(v) OVER (ORDER BY day)) < 1.0 AS stagnant FROM w""")
def stagnation_lag(s, d):
    w = table(s, d, "events", "ts", "value").groupBy(F.date_trunc("day", "ts").alias("day")).agg(F.round(F.avg("value"), 6).alias("v"))
    return w.select("day", "v", (F.abs(F.col("v") - F.lag("v").over(Window.orderBy("day"))) < 1.0).alias("stagnant"))  # one row per day


@query("last_nonnull", "SELECT user_id, arg_max(value, ts) FILTER (event_type = 'purchase') AS last_purchase FROM events GROUP BY user_id")
def last_nonnull(s, d):
    t = table(s, d, "events", "user_id", "event_type", "value", "ts")
    return t.groupBy("user_id").agg(F.max_by("value", F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_purchase"))


@query("view_skew_ntile", """
WITH u AS (SELECT user_id, sum(value) AS v FROM events WHERE event_type = 'view' GROUP BY user_id), r AS (SELECT v, row_number() OVER (ORDER BY v DESC, user_id) AS rn, count(*) OVER () AS n, sum(v) OVER () AS total FROM u)
SELECT round(sum(v) FILTER (rn <= ceil(n * 0.01)) / max(total), 6) AS top1, round(sum(v) FILTER (rn <= ceil(n * 0.1)) / max(total), 6) AS top10 FROM r""")
def view_skew_ntile(s, d):
    u = table(s, d, "events", "user_id", "event_type", "value").where("event_type = 'view'").groupBy("user_id").agg(F.sum("value").alias("v"))
    # counts per distinct value, summed along the values from below by ranges; ties have one value
    c = u.groupBy("v").agg(F.count("*").alias("k"))
    r = sampling.running(c, "v", "k")
    whole = u.agg(F.count("*").alias("n"), F.sum("v").alias("total"))
    r = r.join(F.broadcast(whole)).withColumn("above", F.col("n") - F.col("rn"))  # one row
    share = lambda q: F.sum(F.col("v") * F.greatest(F.lit(0), F.least(F.col("k"), F.ceil(F.col("n") * q) - F.col("above")))) / F.max("total")
    return r.agg(F.round(share(0.01), 6).alias("top1"), F.round(share(0.1), 6).alias("top10"))


# vocabulary


@query("vocab_candidates", r"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[가-힣]+')) AS run FROM documents), n AS (SELECT unnest([2, 3, 4, 5]) AS n),
g AS (SELECT DISTINCT doc_id, run[i:i+n-1] AS g FROM (SELECT doc_id, run, n, unnest(range(1, length(run) - n + 2)) AS i FROM r, n WHERE length(run) >= n)),
s AS (SELECT doc_id, contains(text, '쿠폰') OR contains(text, '셔츠') AS seed FROM documents)
SELECT g, count(*) AS df, count(*) FILTER (seed) AS with_seed, round(ln(1 + count(*)) * greatest(0, length(g) - 2) * (1 + 2 * count(*) FILTER (seed) / count(*)), 6) AS score
FROM g JOIN s USING (doc_id) GROUP BY g HAVING count(*) >= 5""")
def vocab_candidates(s, d):
    """Document frequency of 2- to 5-grams of Hangul runs, with seed co-occurrence and score."""
    t = docs(s, d).select("doc_id", F.regexp_extract_all("text", F.lit("([가-힣]+)"), F.lit(1)).alias("runs"), text.any_term(F.col("text"), ["쿠폰", "셔츠"]).alias("seed"))
    grams = F.flatten(F.transform("runs", lambda r: F.flatten(F.array(*[text.ngrams(r, n) for n in (2, 3, 4, 5)]))))
    g = t.select("seed", F.explode(F.array_distinct(grams)).alias("g"))
    c = g.groupBy("g").agg(F.count("*").alias("df"), F.count_if("seed").alias("with_seed")).where("df >= 5")
    return c.withColumn("score", F.round(F.ln(1 + F.col("df")) * F.greatest(F.lit(0), F.length("g") - 2) * (1 + 2 * F.col("with_seed") / F.col("df")), 6))


@query("vocab_fragment_filter", r"""
WITH t AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[가-힣]+')) AS term FROM valid)
SELECT term FROM t WHERE length(term) BETWEEN 2 AND 4 AND right(term, 1) NOT IN ('는','은','이','가','을','를','의','도','만','에','께','랑','와','과','면','서','로','고','며','다','지') AND left(term, 1) NOT IN ('은','는','을','를','이','가','의','에','도','고','며','지','다','서','받','주','되')""")
def vocab_fragment_filter(s, d):
    t = table(s, d, "valid", "text").select(F.explode(F.regexp_extract_all("text", F.lit("([가-힣]+)"), F.lit(1))).alias("term")).distinct()
    return t.where(F.length("term").between(2, 4) & ~F.right("term", F.lit(1)).isin(packs.BAD_END) & ~F.left("term", F.lit(1)).isin(packs.BAD_START))


@query("vocab_substring_dedup", r"""
WITH c AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT valid_id, unnest(regexp_extract_all(text, '[가-힣]+')) AS term FROM valid) GROUP BY term HAVING count(*) >= 3 AND length(term) BETWEEN 2 AND 6)
SELECT a.term, a.df FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE length(b.term) > length(a.term) AND contains(b.term, a.term) AND a.df <= 1.3 * b.df)""")
def vocab_substring_dedup(s, d):
    """Terms inside a longer term of about their frequency fall. Substrings are listed and joined, not compared in pairs."""
    t = table(s, d, "valid", "valid_id", "text").select("valid_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("([가-힣]+)"), F.lit(1)))).alias("term"))
    c = t.groupBy("term").agg(F.count("*").alias("df")).where("df >= 3").where(F.length("term").between(2, 6))
    sub = F.flatten(F.array(*[text.ngrams(F.col("term"), n) for n in range(2, 6)]))
    inside = c.select(F.explode(F.array_distinct(sub)).alias("t"), F.col("term").alias("longer"), F.col("df").alias("df2")).where("t <> longer")
    hit = c.join(inside, (c.term == inside.t) & (c.df <= 1.3 * inside.df2), "left_anti")
    return hit.select("term", "df")


# M: distribution metrics

_SIDE = "CASE WHEN split = 'train' THEN 'a' ELSE 'b' END"


def _jsd_sql(n: int) -> str:
    return f"""
WITH g AS (SELECT {_SIDE} AS side, output[i:i+{n - 1}] AS g FROM (SELECT split, output, unnest(range(1, length(output) - {n} + 2)) AS i FROM round2_build_tc_sft WHERE output IS NOT NULL AND length(output) >= {n})),
c AS (SELECT g, count(*) FILTER (side = 'a') AS p, count(*) FILTER (side = 'b') AS q FROM g GROUP BY g), n AS (SELECT sum(p) AS P1, sum(q) AS Q1 FROM c),
x AS (SELECT p / P1 AS p, q / Q1 AS q FROM c, n)
SELECT round(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 6) AS jsd FROM x"""


def _split_side():
    return F.when(F.col("split") == "train", "a").otherwise("b")


@query("unigram_jsd_splits", _jsd_sql(1))
def unigram_jsd_splits(s, d):
    return metrics.jsd(metrics.gram_counts(table(s, d, "round2_build_tc_sft", "split", "output"), _split_side(), "output", 1), "a", "b")


@query("bigram_jsd_splits", _jsd_sql(2))
def bigram_jsd_splits(s, d):
    return metrics.jsd(metrics.gram_counts(table(s, d, "round2_build_tc_sft", "split", "output"), _split_side(), "output", 2), "a", "b")


_HIST = f"""
WITH e(i, top) AS (VALUES (0,0),(1,10),(2,20),(3,35),(4,60),(5,100),(6,160),(7,260),(8,400),(9,600),(10,900),(11,1400),(12,2200)),
b AS (SELECT {_SIDE} AS side, coalesce((SELECT min(i) FROM e WHERE length(output) <= top), 13) AS bin FROM round2_build_tc_sft WHERE output IS NOT NULL),
h AS (SELECT r.i, count(*) FILTER (side = 'a') AS p, count(*) FILTER (side = 'b') AS q FROM range(14) r(i) LEFT JOIN b ON b.bin = r.i GROUP BY r.i), n AS (SELECT sum(p) AS P1, sum(q) AS Q1 FROM h)
"""


def _hist(s, d):
    t = table(s, d, "round2_build_tc_sft", "split", "output").where("output is not null")
    return t.groupBy(_split_side().alias("side"), text.bin14(F.col("output")).alias("bin")).agg(F.count("*").alias("k"))


@query("length_kl", _HIST + "SELECT round(sum(CASE WHEN p > 0 THEN p / P1 * ln((p / P1) / (q / Q1 + 1e-12)) ELSE 0 END), 6) AS kl FROM h, n")
def length_kl(s, d):
    return metrics.hist_kl(_hist(s, d), 14, "a", "b")


@query("length_kl_additive", _HIST + "SELECT round(sum((p / P1 + 1e-6) * ln((p / P1 + 1e-6) / (q / Q1 + 1e-6))), 6) AS kl FROM h, n")
def length_kl_additive(s, d):
    return metrics.hist_kl(_hist(s, d), 14, "a", "b", 1e-6, both=True)


@query("density_delta", f"""
SELECT round(abs(avg(len(regexp_extract_all(output, '[0-9]')) / length(output)) FILTER (split = 'train') - avg(len(regexp_extract_all(output, '[0-9]')) / length(output)) FILTER (split = 'eval')), 6) AS digit_delta,
 round(abs(avg(len(regexp_extract_all(output, '[A-Za-z]')) / length(output)) FILTER (split = 'train') - avg(len(regexp_extract_all(output, '[A-Za-z]')) / length(output)) FILTER (split = 'eval')), 6) AS english_delta FROM round2_build_tc_sft WHERE length(output) > 0""")
def density_delta(s, d):
    t = table(s, d, "round2_build_tc_sft", "split", "output").where(F.length("output") > 0)
    side = lambda x, p: F.avg(F.when(F.col("split") == x, text.density(F.col("output"), p)))
    return t.agg(*[F.round(F.abs(side("train", p) - side("eval", p)), 6).alias(k) for k, p in (("digit_delta", "[0-9]"), ("english_delta", "[A-Za-z]"))])


@query("presence_alignment", "WITH t(term) AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in TERMS) + """])), r AS (SELECT term, avg(CASE WHEN contains(output, term) THEN 1 ELSE 0 END) FILTER (split = 'train') AS raw, avg(CASE WHEN contains(output, term) THEN 1 ELSE 0 END) FILTER (split = 'eval') AS side FROM round2_build_tc_sft, t WHERE output IS NOT NULL GROUP BY term)
SELECT round(min(CASE WHEN raw = 0 THEN 1.0 ELSE least(side / raw, 1.0) END), 6) AS alignment FROM r""")
def presence_alignment(s, d):
    p = metrics.presence(table(s, d, "round2_build_tc_sft", "split", "output"), F.col("split"), "output", TERMS)
    w = p.groupBy("term").agg(F.max(F.when(F.col("side") == "train", F.col("ratio"))).alias("raw"), F.max(F.when(F.col("side") == "eval", F.col("ratio"))).alias("side"))
    return w.agg(F.round(F.min(F.when(F.col("raw") == 0, 1.0).otherwise(F.least(F.col("side") / F.col("raw"), F.lit(1.0)))), 6).alias("alignment"))


@query("ratio_match_grouping_sets", r"""
WITH r AS (SELECT kind, avg(CASE WHEN regexp_matches(output, '\?') THEN 1 ELSE 0 END) FILTER (split = 'train') AS qa, avg(CASE WHEN regexp_matches(output, '\?') THEN 1 ELSE 0 END) FILTER (split = 'eval') AS qb,
 avg(CASE WHEN regexp_matches(output, '!') THEN 1 ELSE 0 END) FILTER (split = 'train') AS ea, avg(CASE WHEN regexp_matches(output, '!') THEN 1 ELSE 0 END) FILTER (split = 'eval') AS eb,
 avg(CASE WHEN regexp_matches(output, '\.{2,}|…') THEN 1 ELSE 0 END) FILTER (split = 'train') AS da, avg(CASE WHEN regexp_matches(output, '\.{2,}|…') THEN 1 ELSE 0 END) FILTER (split = 'eval') AS db FROM round2_build_tc_sft WHERE output IS NOT NULL GROUP BY GROUPING SETS ((kind), ()))
SELECT coalesce(kind, 'any') AS kind, round(greatest(abs(qa - qb), abs(ea - eb), abs(da - db)), 6) AS worst FROM r""")
def ratio_match_grouping_sets(s, d):
    t = table(s, d, "round2_build_tc_sft", "kind", "split", "output").where("output is not null")
    side = lambda x, p: F.avg(F.when(F.col("split") == x, F.col("output").rlike(p).cast("int")))
    worst = F.greatest(*[F.abs(side("train", p) - side("eval", p)) for p in packs.PUNCT.values()])
    return t.groupingSets([("kind",), ()], "kind").agg(F.round(worst, 6).alias("worst")).select(F.coalesce("kind", F.lit("any")).alias("kind"), "worst")


@query("tone_match", r"""
WITH v AS (SELECT split, len(regexp_extract_all(output, '(?m)(합니다|합니까|하세요|하십시오|하시겠|입니다|습니다|습니까|세요|시오|겠습|에요|예요|해요|하죠|죠)[ \t\n\r\f\x0b]*[.?!]?[ \t\n\r\f\x0b]*$')) AS a, len(regexp_extract_all(output, '(?m)(해|했|한다|했다|하지|했지|함|했음|인데|인듯|거든|거임|임|음|ㅋ|ㅎ|ㅠ|ㅜ)[ \t\n\r\f\x0b]*[.?!]?[ \t\n\r\f\x0b]*$')) AS b FROM round2_build_tc_sft WHERE output IS NOT NULL),
t AS (SELECT split, CASE WHEN a + b > 0 AND a / (a + b) > 0.7 THEN 1 ELSE 0 END AS polite, CASE WHEN a + b > 0 AND b / (a + b) > 0.7 THEN 1 ELSE 0 END AS casual FROM v)
SELECT round(greatest(abs(avg(polite) FILTER (split = 'train') - avg(polite) FILTER (split = 'eval')), abs(avg(casual) FILTER (split = 'train') - avg(casual) FILTER (split = 'eval'))), 6) AS tone_delta FROM t""")
def tone_match(s, d):
    """The larger difference between the splits in the shares of polite and of casual texts."""
    t = table(s, d, "round2_build_tc_sft", "split", "output").where("output is not null").withColumn("tone", text.tone_votes(F.col("output")))
    share = lambda x, tone: F.avg(F.when(F.col("split") == x, (F.col("tone") == tone).cast("int")))
    return t.agg(F.round(F.greatest(*[F.abs(share("train", k) - share("eval", k)) for k in ("존댓말", "반말")]), 6).alias("tone_delta"))


@query("reply_depth_hist", "SELECT split, least(depth, 4) AS bin, count(*) AS n FROM round2_build_tc_sft WHERE depth IS NOT NULL GROUP BY 1, 2")
def reply_depth_hist(s, d):
    return table(s, d, "round2_build_tc_sft", "split", "depth").where("depth is not null").groupBy("split", F.least("depth", F.lit(4)).alias("bin")).agg(F.count("*").alias("n"))


_DEPTH = r"CASE WHEN regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1) = '' THEN 0 ELSE least(4, len(string_split(regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1), '-'))) END"


@query("reply_depth_kl", f"""
WITH b AS (SELECT {_SIDE} AS side, {_DEPTH} AS bin FROM round2_build_tc_sft WHERE output IS NOT NULL AND lower(trim(kind)) IN ('comment', 'context_comment', 'reply', 'comments')),
h AS (SELECT r.i, count(*) FILTER (side = 'a') AS p, count(*) FILTER (side = 'b') AS q FROM range(5) r(i) LEFT JOIN b ON b.bin = r.i GROUP BY r.i), n AS (SELECT sum(p) AS P1, sum(q) AS Q1 FROM h)
SELECT coalesce(round(sum(CASE WHEN p > 0 THEN p / P1 * ln((p / P1) / (q / Q1 + 1e-12)) ELSE 0 END), 6), 0.0) AS kl FROM h, n""")
def reply_depth_kl(s, d):
    """KL of the reply depths 0 to 4 and more, over comments only; 0 if a side has none."""
    t = table(s, d, "round2_build_tc_sft", "split", "kind", "output").where("output is not null").where(text.kind_of(F.col("kind")) == "comment")
    h = t.groupBy(_split_side().alias("side"), F.least(text.reply_parts(F.col("output"))["segments"], F.lit(4)).alias("bin")).agg(F.count("*").alias("k"))
    return metrics.hist_kl(h, 5, "a", "b").select(F.coalesce("kl", F.lit(0.0)).alias("kl"))


def _match_sql(patterns: dict[str, str]) -> str:
    share = lambda side, p: f"avg(CASE WHEN regexp_matches(output, '{p}') THEN 1 ELSE 0 END) FILTER (split = '{side}')"
    worst = ", ".join(f"abs({share('train', p)} - {share('eval', p)})" for p in patterns.values())
    return f"SELECT max(worst) AS worst FROM (SELECT round(greatest({worst}), 6) AS worst FROM round2_build_tc_sft WHERE output IS NOT NULL GROUP BY GROUPING SETS ((kind), ()))"


def _matched(s, d, patterns):
    t = table(s, d, "round2_build_tc_sft", "kind", "split", "output")
    return metrics.ratio_match(t, F.col("split"), "train", "eval", "kind", "output", patterns).agg(F.max("worst").alias("worst"))


@query("punct_match", _match_sql(packs.PUNCT))
def punct_match(s, d):
    return _matched(s, d, packs.PUNCT)


@query("initial_match", _match_sql(packs.INITIALS))
def initial_match(s, d):
    return _matched(s, d, packs.INITIALS)


@query("persona_share", """
WITH p AS (SELECT id FROM persona_list), r AS (SELECT TRY_CAST(nullif(regexp_extract(lower(trim(persona_id)), '^p?-?0*([0-9]+)$', 1), '') AS INTEGER) AS n, persona FROM round2_build_tc_sft)
SELECT round(count(*) FILTER (n IN (SELECT id FROM p) OR persona IN (SELECT name FROM persona_list)) / count(*), 6) AS consistency FROM r""")
def persona_share(s, d):
    """Rows whose persona, by number or by name, is in the list."""
    r = table(s, d, "round2_build_tc_sft", "persona_id", "persona").select(text.persona_number(F.col("persona_id")).alias("id"), F.col("persona").alias("name"))
    p = table(s, d, "persona_list", "id", "name")
    known = lambda c: F.broadcast(p.select(c).where(F.col(c).isNotNull()).distinct().withColumn(f"has_{c}", F.lit(True)))  # noqa: E731  the fixed persona list
    m = r.join(known("id"), "id", "left").join(known("name"), "name", "left")
    return m.agg(F.round(F.count_if(F.coalesce("has_id", "has_name", F.lit(False))) / F.count("*"), 6).alias("consistency"))


_HALF = "CASE WHEN ('0x' || sha256(CAST(row_id AS VARCHAR) || ':run')[1:16])::UBIGINT % 2 = 0 THEN 'a' ELSE 'b' END"


@query("bigram_jsd_halves", _jsd_sql(2).replace(_SIDE, _HALF).replace("SELECT split, output, unnest", "SELECT row_id, output, unnest"))
def bigram_jsd_halves(s, d):
    """Agreement of two runs: bigrams of two halves of the outputs, by hash."""
    half = F.when(text.hash64_mod(F.concat(F.col("row_id").cast("string"), F.lit(":run")), 2) == 0, "a").otherwise("b")
    return metrics.jsd(metrics.gram_counts(table(s, d, "round2_build_tc_sft", "row_id", "output"), half, "output", 2), "a", "b")


_KL_AB, _KL_BA = "sum((p / P1 + 1e-6) * ln((p / P1 + 1e-6) / (q / Q1 + 1e-6)))", "sum((q / Q1 + 1e-6) * ln((q / Q1 + 1e-6) / (p / P1 + 1e-6)))"


@query("calibration_targets", f"""
WITH l AS ({_HIST} SELECT {_KL_AB} AS ab, {_KL_BA} AS ba FROM h, n), u AS ({_jsd_sql(1)}), b AS ({_jsd_sql(2)})
SELECT round((ab + ba) / 2, 6) AS length_kl_symmetric, greatest(0.08, round(b.jsd * 1.5, 6)) AS bigram_primary, greatest(0.05, round(b.jsd * 1.2, 6)) AS bigram_stretch, greatest(0.04, round(u.jsd * 1.5, 6)) AS unigram_primary,
 greatest(0.10, round(ab + ba, 6)) AS length_kl_primary FROM l, u, b""")
def calibration_targets(s, d):
    """The symmetric KL of lengths, and targets as multiples of what one side of the corpus is to the other."""
    h = _hist(s, d)
    kl = metrics.hist_kl_symmetric(h, 14, "a", "b", 1e-6)
    u, b = unigram_jsd_splits(s, d).select(F.col("jsd").alias("u")), bigram_jsd_splits(s, d).select(F.col("jsd").alias("b"))
    one = kl.join(F.broadcast(u)).join(F.broadcast(b))  # one row each
    target = lambda floor, x: F.greatest(F.lit(floor), F.round(x, 6))
    return one.select(
        F.round("kl", 6).alias("length_kl_symmetric"), target(0.08, F.col("b") * 1.5).alias("bigram_primary"), target(0.05, F.col("b") * 1.2).alias("bigram_stretch"),
        target(0.04, F.col("u") * 1.5).alias("unigram_primary"), target(0.10, F.col("kl") * 2).alias("length_kl_primary"),
    )


@query("group_trigram_cosine", """
WITH g AS (SELECT source, text[i:i+2] AS g FROM (SELECT source, text, unnest(range(1, length(text) - 1)) AS i FROM documents WHERE length(text) >= 3)), c AS (SELECT source, g, count(*) AS k FROM g GROUP BY 1, 2),
n AS (SELECT source, sqrt(sum(k * k)) AS n FROM c GROUP BY 1)
SELECT a.source AS a, b.source AS b, round(sum(a.k * b.k) / (max(na.n) * max(nb.n)), 6) AS cosine FROM c a JOIN c b ON a.g = b.g AND a.source < b.source JOIN n na ON na.source = a.source JOIN n nb ON nb.source = b.source GROUP BY 1, 2""")
def group_trigram_cosine(s, d):
    c = metrics.gram_counts(docs(s, d, "source"), F.col("source"), "text", 3)
    n = c.groupBy("side").agg(F.sqrt(F.sum(F.col("k") * F.col("k"))).alias("n"))
    # the sources are a handful: per gram their counts are one small map, and pairs are formed within it
    m = c.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("side", "k"))).alias("s"))
    x = m.select(F.explode("s").alias("x"), "s").select("x", F.explode(F.filter("s", lambda y: y["side"] > F.col("x.side"))).alias("y"))
    dot = x.groupBy(F.col("x.side").alias("a"), F.col("y.side").alias("b")).agg(F.sum(F.col("x.k") * F.col("y.k")).alias("dot"))
    na, nb = n.select(F.col("side").alias("a"), F.col("n").alias("na")), n.select(F.col("side").alias("b"), F.col("n").alias("nb"))
    return dot.join(na, "a").join(nb, "b").select("a", "b", F.round(F.col("dot") / (F.col("na") * F.col("nb")), 6).alias("cosine"))


@query("accuracy_drop_gate", """
WITH a AS (SELECT reviewer, avg(abusive) AS v FROM valid_labels GROUP BY reviewer), b AS (SELECT avg(abusive) AS base FROM valid_labels)
SELECT reviewer, round(v - base, 6) AS delta, v - base >= -0.05 AS ok FROM a, b""")
def accuracy_drop_gate(s, d):
    t = table(s, d, "valid_labels", "reviewer", "abusive")
    a = t.groupBy("reviewer").agg(F.avg("abusive").alias("v")).join(F.broadcast(t.agg(F.avg("abusive").alias("base"))))
    return a.select("reviewer", F.round(F.col("v") - F.col("base"), 6).alias("delta"), (F.col("v") - F.col("base") >= -0.05).alias("ok"))


QUERIES = Q
