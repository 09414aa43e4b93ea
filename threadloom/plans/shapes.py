"""Text shapes, filters on pairs, profiles and baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import packs, scrub, text
from ..operators import dedup, filters, metrics, quantiles, sampling
from ..session import spread, table
from . import audit, corpus

Q: dict = {}
T = "round2_build_tc_sft"
S = r"[ \t\n\r\f\x0b]"


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def sft(s, d, *cols: str) -> DataFrame:
    return table(s, d, T, *cols)


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{text.WS}+|{text.WS}+$', '', 'g')"


def _runs(chars) -> str:
    return "|".join(f"{c}{c}+" for c in chars)


_JAMO = [chr(c) for c in (*range(0x3131, 0x314F), *range(0x314F, 0x3164))]


@query("repeat_runs_all", f"SELECT valid_id, len(regexp_extract_all(text, '{_runs(_JAMO)}')) AS jamo_runs, len(regexp_extract_all(text, '{_runs(['[?]', '!', '[.]', '~'])}')) AS punct_runs FROM valid")
def repeat_runs_all(s, d):
    """Runs of any one letter, and of any one mark, by back-reference."""
    t = table(s, d, "valid", "valid_id", "text")
    return t.select("valid_id", F.regexp_count("text", F.lit(r"([ㄱ-ㅎㅏ-ㅣ])\1+")).cast("long").alias("jamo_runs"), F.regexp_count("text", F.lit(r"([?!.~])\1+")).cast("long").alias("punct_runs"))


_COUNT = " + ".join(f"(length(text) - length(replace(text, '{t}', ''))) // {len(t)}" for t in packs.TERMS)


@query("term_density", f"SELECT doc_id, round(CASE WHEN length(text) > 0 THEN ({_COUNT}) / length(text) * 1000 ELSE 0.0 END, 6) AS per_thousand FROM documents WHERE text IS NOT NULL")
def term_density(s, d):
    return corpus.docs(s, d).where("text is not null").select("doc_id", F.round(text.term_density(F.col("text"), packs.TERMS), 6).alias("per_thousand"))


@query("comments_cleaned", rf"""
WITH t AS (SELECT row_id, {_strip("replace(output, chr(160), ' ')")} AS t FROM {T} WHERE output IS NOT NULL), b AS (SELECT row_id, t, regexp_replace(regexp_replace(t, '{text.OWN_TAG}[ \t\n\r\f]*', ''), '{text.REF_TAGS}', '') AS b FROM t)
SELECT row_id, nullif(regexp_extract(t, '{text.OWN_TAG}', 1), '') AS reply_key, {_strip('b')} AS body FROM b""")
def comments_cleaned(s, d):
    c = text.cleaned_comment(F.col("output"))
    return sft(s, d, "row_id", "output").where("output is not null").select("row_id", c["key"].alias("reply_key"), c["body"].alias("body"))


_KIND = "CASE WHEN lower(trim(kind)) IN ('comment', 'context_comment', 'reply', 'comments') THEN 'comment' WHEN lower(trim(kind)) IN ('post', 'context_post', 'post_title', 'article') THEN 'post' END"


@query("kinds_derived", f"""
SELECT row_id, coalesce({_KIND.replace('kind', 'source')}, CASE WHEN regexp_matches(lower(concat_ws(chr(10), instruction, input)), '댓글|답글|comment|reply') THEN 'comment' WHEN regexp_matches(lower(concat_ws(chr(10), instruction, input)), '게시글|본문|post|원글') THEN 'post' END,
 CASE WHEN regexp_matches(output, '^[ \\t\\n]*\\[[0-9]+(?:-[0-9]+)*\\]') THEN 'comment' ELSE 'post' END) AS kind FROM {T}""")
def kinds_derived(s, d):
    """The cascade with the column source in the place of a declared kind."""
    none = F.lit(None).cast("string")
    k = text.kind_derived([F.col("source")], none, none, [F.col("instruction"), F.col("input")], F.col("output"))
    return sft(s, d, "row_id", "source", "instruction", "input", "output").select("row_id", k.alias("kind"))


@query("row_texts", f"SELECT row_id, concat_ws(chr(10), nullif(instruction, ''), nullif(input, ''), nullif(output, ''), nullif(persona_id, '')) AS text FROM {T}")
def row_texts(s, d):
    t = sft(s, d, "row_id", "instruction", "input", "output", "persona_id")
    return t.select("row_id", text.joined(*[F.col(c) for c in ("instruction", "input", "output", "persona_id")]).alias("text"))


_ANSWER = "CASE valid_id % 4 WHEN 0 THEN '{\"label\": \"' || CASE WHEN abusive = 1 THEN 'ai' ELSE 'human' END || '\", \"rationale\": \"x\"}' WHEN 1 THEN 'I say ' || CASE WHEN abusive = 1 THEN 'AI' ELSE 'human' END || '.' WHEN 2 THEN 'unsure' ELSE '{\"label\": \"maybe\"} AI' END"


@query("labels_parsed", f"""
WITH a AS (SELECT valid_id, {_ANSWER} AS answer FROM valid_labels), j AS (SELECT valid_id, answer, upper(trim(json_extract_string(CASE WHEN json_valid(answer) THEN answer END, '$.label'))) AS given, upper(regexp_extract(answer, '(?i)\\b(AI|HUMAN)\\b', 1)) AS named FROM a)
SELECT valid_id, coalesce(CASE WHEN given IN ('AI', 'HUMAN') THEN given END, nullif(named, ''), 'HUMAN') AS label FROM j""")
def labels_parsed(s, d):
    """Answers of a judge in four shapes, made from the reviewed sample, and the label read from each."""
    yes, m = F.col("abusive") == 1, F.col("valid_id") % 4
    answer = (
        F.when(m == 0, F.concat(F.lit('{"label": "'), F.when(yes, "ai").otherwise("human"), F.lit('", "rationale": "x"}')))
        .when(m == 1, F.concat(F.lit("I say "), F.when(yes, "AI").otherwise("human"), F.lit(".")))
        .when(m == 2, F.lit("unsure"))
        .otherwise(F.lit('{"label": "maybe"} AI'))
    )
    return table(s, d, "valid_labels", "valid_id", "abusive").select("valid_id", text.label_of(answer).alias("label"))


_LINES = f"list_filter(list_transform(string_split(output, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"


@query("formal_tails_dropped", f"""
WITH l AS (SELECT row_id, output, {_LINES} AS l FROM {T} WHERE output IS NOT NULL)
SELECT row_id, coalesce(nullif(array_to_string(CASE WHEN regexp_matches(l[-1], '(?:습니다|입니다|드립니다|하겠습니다)[ \\t]*[.!?~]*$') THEN l[:-2] ELSE l END, chr(10)), ''), {_strip('output')}) AS kept FROM l""")
def formal_tails_dropped(s, d):
    return sft(s, d, "row_id", "output").where("output is not null").select("row_id", text.without_formal_tail(F.col("output")).alias("kept"))


# filters


_FORMAL = filters.FORMAL_GENERATED.replace(r"\s", S)


@query("formal_generated", f"SELECT row_id FROM {T} WHERE regexp_matches(output, '{_FORMAL}')")
def formal_generated(s, d):
    return sft(s, d, "row_id", "output").where(F.col("output").rlike(filters.FORMAL_GENERATED)).select("row_id")


_AD = "(?i)(?:" + packs.AD.replace(r"\s", S) + ")"


@query("dense_promo", f"SELECT record_id FROM phase1_data_pipeline WHERE regexp_matches(text, '01[016789][- .]?[0-9]{{3,4}}[- .]?[0-9]{{4}}') OR regexp_matches(text, 'https?://') OR len(regexp_extract_all(text, '{_AD}')) / greatest(length(text), 1) > 0.3")
def dense_promo(s, d):
    return table(s, d, "phase1_data_pipeline", "record_id", "text").where(filters.is_dense_promo(F.col("text"))).select("record_id")


_REASON = f"CASE WHEN regexp_matches({{c}}, '{packs.BLOCKED}') THEN 'blocked_deleted' WHEN regexp_matches({{c}}, '{packs.CONTACT.replace('{', '{{').replace('}', '}}')}') THEN 'contact_or_url' WHEN regexp_matches({{c}}, '{packs.PROMO}') THEN 'promo_template' END"


@query("pair_reasons", f"""
WITH r AS (SELECT coalesce({_REASON.format(c='output')}, {_REASON.format(c='instruction')}) AS reason FROM {T} WHERE output IS NOT NULL AND instruction IS NOT NULL)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS rows FROM r GROUP BY 1""".replace(r"\s", S))
def pair_reasons(s, d):
    """The launch rules on pairs: the first side that has a reason gives it."""
    t = sft(s, d, "instruction", "output").where("output is not null and instruction is not null")
    r = F.coalesce(filters.launch_reason(F.col("output")), filters.launch_reason(F.col("instruction")))
    return t.groupBy(F.coalesce(r, F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


@query("valid_triples", f"SELECT row_id FROM {T} WHERE {_strip('instruction')} <> '' AND {_strip('output')} <> '' AND {_strip('persona')} <> ''")
def valid_triples(s, d):
    full = lambda c: text.strip(F.col(c)) != ""
    return sft(s, d, "row_id", "instruction", "output", "persona").where(full("instruction") & full("output") & full("persona")).select("row_id")


@query("missing_keys", "SELECT k AS key, count(*) FILTER (NOT list_contains(json_keys(props), k)) AS rows_without FROM events, (SELECT unnest(['page', 'ref', 'k', 'v']) AS k) WHERE props IS NOT NULL GROUP BY k")
def missing_keys(s, d):
    """Rows of JSON without a required key; a required key no row has counts them all."""
    keys = ["page", "ref", "k", "v"]
    t = table(s, d, "events", "props").where("props is not null").select(F.json_object_keys("props").alias("ks"))
    one = t.agg(*[F.count_if(~F.array_contains("ks", k)).alias(k) for k in keys])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("rows_without")) for k in keys])))


@query("entropy_low", f"""
WITH e AS ({corpus.QUERIES['entropy_gate'][1]}) SELECT d.doc_id, coalesce(e.entropy < 6.5, FALSE) AS low FROM documents d LEFT JOIN e USING (doc_id)""")
def entropy_low(s, d):
    """The gate itself: whether all long enough cells of a row are below a threshold."""
    return filters.entropy_reason(corpus.docs(s, d), "doc_id", ["text"], 6.5).select(F.col("key").alias("doc_id"), "low")


@query("entropy_percentiles", f"""
WITH o AS (SELECT entropy AS v, row_number() OVER (ORDER BY entropy) AS rn, count(*) OVER () AS n FROM ({corpus.QUERIES['entropy_gate'][1]}))
SELECT min(v) AS least, min(CASE WHEN rn = least(n, CAST(floor(n * 0.01) AS BIGINT) + 1) THEN v END) AS p1, min(CASE WHEN rn = least(n, CAST(floor(n * 0.5) AS BIGINT) + 1) THEN v END) AS p50, min(CASE WHEN rn = least(n, CAST(floor(n * 0.9) AS BIGINT) + 1) THEN v END) AS p90, max(v) AS most FROM o""")
def entropy_percentiles(s, d):
    """Percentiles of the entropies: ranks come from running counts by ranges."""
    e = filters.entropy(corpus.docs(s, d), "doc_id", "text")
    p = quantiles.percentiles(e, F.col("entropy"), [0.01, 0.5, 0.9], "floor")
    return p.join(F.broadcast(e.agg(F.min("entropy").alias("least"), F.max("entropy").alias("most")))).select("least", "p1", "p50", "p90", "most")  # one row


# deduplication


@query("thread_jaccard_greedy", None)
def thread_jaccard_greedy(s, d):
    """Comments that stay after the greedy removal within their thread; posts never fall."""
    t = table(s, d, "phase1_data_pipeline", "record_id", "thread_key", "kind", "text")
    kept = dedup.thread_greedy(t, "record_id", "thread_key", "text", F.col("kind") == "post")
    return kept.where("kept").select(F.col("k").alias("record_id"))


@query("minhash_cluster_sizes", None)
def minhash_cluster_sizes(s, d):
    """Clusters by size, and how many have it."""
    return dedup.minhash_clusters(corpus.docs(s, d), "doc_id", "text").groupBy("size").agg(F.count("*").alias("clusters"))


@query("duplicate_levels", "SELECT t AS table_name, round((count(*) - count(DISTINCT x)) / count(*), 6) AS duplicate_rate, CASE WHEN (count(*) - count(DISTINCT x)) / count(*) > 0.5 THEN 'severe' WHEN (count(*) - count(DISTINCT x)) / count(*) > 0.35 THEN 'warn' ELSE 'ok' END AS level FROM (SELECT 'valid' AS t, text AS x FROM valid UNION ALL SELECT 'documents', text FROM documents UNION ALL SELECT 'outputs', output FROM round2_build_tc_sft) WHERE x IS NOT NULL GROUP BY t")
def duplicate_levels(s, d):
    u = table(s, d, "valid", "text").select(F.lit("valid").alias("table_name"), "text").unionByName(corpus.docs(s, d).select(F.lit("documents").alias("table_name"), "text"))
    u = u.unionByName(sft(s, d, "output").select(F.lit("outputs").alias("table_name"), F.col("output").alias("text"))).where("text is not null")
    g = u.groupBy("table_name", F.sha2("text", 256).alias("h")).agg(F.count("*").alias("k")).groupBy("table_name").agg(F.sum("k").alias("n"), F.count("*").alias("u"))
    r = (F.col("n") - F.col("u")) / F.col("n")
    return g.select("table_name", F.round(r, 6).alias("duplicate_rate"), F.when(r > 0.5, "severe").when(r > 0.35, "warn").otherwise("ok").alias("level"))


# profiles and baselines


_STATS = {"floor": [0.5, 0.9], "nearest": [0.95, 0.99]}


@query("length_stats", """
WITH o AS (SELECT length(output) AS v, row_number() OVER (ORDER BY length(output)) AS rn, count(*) OVER () AS n FROM round2_build_tc_sft WHERE output IS NOT NULL)
SELECT round(avg(v), 6) AS mean, min(CASE WHEN rn = greatest(1, CAST(ceil(n * 0.5) AS BIGINT)) THEN v END) AS p50, min(CASE WHEN rn = greatest(1, CAST(ceil(n * 0.9) AS BIGINT)) THEN v END) AS p90,
 min(CASE WHEN rn = greatest(1, CAST(ceil(n * 0.95) AS BIGINT)) THEN v END) AS p95, min(CASE WHEN rn = greatest(1, CAST(ceil(n * 0.99) AS BIGINT)) THEN v END) AS p99, max(v) AS most, min(CASE WHEN rn = n // 2 + 1 THEN v END) AS upper_middle FROM o""")
def length_stats(s, d):
    """Mean, percentiles by the nearest rank, the maximum, and the upper of the two middle rows."""
    t = sft(s, d, "output").where("output is not null").select(F.length("output").cast("long").alias("v"))
    p = quantiles.percentiles(t, F.col("v"), [0.5, 0.9, 0.95, 0.99], "nearest")
    m = quantiles.percentiles(t, F.col("v"), [0.5], "upper_middle").select(F.col("p50").alias("upper_middle"))
    one = t.agg(F.round(F.avg("v"), 6).alias("mean"), F.max("v").alias("most"))
    return one.join(F.broadcast(p)).join(F.broadcast(m)).select("mean", "p50", "p90", "p95", "p99", "most", "upper_middle")  # one row each


@query("corpus_profile", rf"""
SELECT CASE WHEN split = 'train' THEN 'a' ELSE 'b' END AS side, count(*) AS records, round(avg(length(output)), 6) AS mean_chars, CAST(sum(length(output)) AS BIGINT) AS unigrams, CAST(sum(greatest(length(output) - 1, 0)) AS BIGINT) AS bigrams,
 round(sum(len(regexp_extract_all(output, '[가-힣]'))) / sum(length(output)), 6) AS hangul, round(sum(len(regexp_extract_all(output, '[ㄱ-ㅎㅏ-ㅣ]'))) / sum(length(output)), 6) AS jamo, round(sum(len(regexp_extract_all(output, '[0-9]'))) / sum(length(output)), 6) AS digit,
 round(sum(len(regexp_extract_all(output, '[A-Za-z]'))) / sum(length(output)), 6) AS english, round(sum(len(regexp_extract_all(output, '{_runs(_JAMO)}'))) / count(*), 6) AS jamo_runs, round(sum(len(regexp_extract_all(output, '{_runs(['[?]', '!', '[.]', '~'])}'))) / count(*), 6) AS punct_runs
FROM {T} WHERE output IS NOT NULL GROUP BY 1""")
def corpus_profile(s, d):
    """Densities over all characters of a side, n-gram totals and runs per record, in one pass."""
    c, n = F.col("output"), F.sum(F.length("output"))
    dens = lambda p: F.round(F.sum(text.count_of(c, p)) / n, 6)
    per = lambda p: F.round(F.sum(F.regexp_count(c, F.lit(p))) / F.count("*"), 6)
    side = F.when(F.col("split") == "train", "a").otherwise("b")
    return sft(s, d, "split", "output").where("output is not null").groupBy(side.alias("side")).agg(
        F.count("*").alias("records"), F.round(F.avg(F.length(c)), 6).alias("mean_chars"), n.cast("long").alias("unigrams"), F.sum(F.greatest(F.length(c) - 1, F.lit(0))).cast("long").alias("bigrams"),
        dens("[가-힣]").alias("hangul"), dens("[ㄱ-ㅎㅏ-ㅣ]").alias("jamo"), dens("[0-9]").alias("digit"), dens("[A-Za-z]").alias("english"), per(r"([ㄱ-ㅎㅏ-ㅣ])\1+").alias("jamo_runs"), per(r"([?!.~])\1+").alias("punct_runs"),
    )


@query("term_baseline", "WITH t(term) AS (SELECT unnest([" + ", ".join(f"'{t}'" for t in packs.TERMS) + """])), o AS (SELECT term, CAST((length(text) - length(replace(text, term, ''))) / length(term) AS BIGINT) AS k FROM documents, t WHERE text IS NOT NULL)
SELECT term, CAST(sum(k) AS BIGINT) AS occurrences, count(*) FILTER (k > 0) AS doc_freq, round(count(*) FILTER (k > 0) / count(*), 6) AS doc_ratio FROM o GROUP BY term""")
def term_baseline(s, d):
    """Occurrences, document frequency and document ratio of every term."""
    t = metrics.term_fires(spread(corpus.docs(s, d).where("text is not null")), "text", packs.TERMS)
    return t.select("term", F.col("fires").alias("occurrences"), F.col("rows_with").alias("doc_freq"), F.round(F.col("rows_with") / F.col("rows"), 6).alias("doc_ratio"))


@query("topic_ratios", f"SELECT topic, docs, round(docs / (SELECT count(*) FROM documents), 6) AS ratio FROM ({corpus.QUERIES['topics_multilabel'][1]})")
def topic_ratios(s, d):
    n = table(s, d, "documents", "doc_id").agg(F.count("*").alias("n"))
    return corpus.topics_multilabel(s, d).join(F.broadcast(n)).select("topic", "docs", F.round(F.col("docs") / F.col("n"), 6).alias("ratio"))  # one row


_SCRUB = corpus.QUERIES["pii_scrub_ordered"][1]
_STEPS = ["rrn", "phone", "business", "account", "email", "url"]


@query("pii_totals", "SELECT " + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in _STEPS) + f", count(*) FILTER ({' + '.join(_STEPS)} > 0) AS rows_changed FROM ({_SCRUB})")
def pii_totals(s, d):
    p = corpus.pii_scrub_ordered(s, d)
    return p.agg(*[F.sum(k).cast("long").alias(k) for k in _STEPS], F.count_if(sum((F.col(k) for k in _STEPS), F.lit(0)) > 0).alias("rows_changed"))


@query("detection_verdicts", f"""
SELECT reviewer, n, hits, low, high, CASE WHEN n < 20 THEN 'TOO_FEW' WHEN hits / n > 0.50 OR high >= 0.50 THEN 'REJECT' WHEN hits / n > 0.40 THEN 'MARGINAL' ELSE 'PASS' END AS verdict FROM ({audit.QUERIES['wilson_ci'][1]})""")
def detection_verdicts(s, d):
    r, few = F.col("hits") / F.col("n"), F.col("n") < 20
    return audit.wilson_ci(s, d).withColumn("verdict", F.when(few, "TOO_FEW").when((r > 0.50) | (F.col("high") >= 0.50), "REJECT").when(r > 0.40, "MARGINAL").otherwise("PASS"))


@query("fertility_quantiles", rf"""
WITH f AS (SELECT round(length(text) / greatest(1, len(regexp_extract_all(text, '[^ \t\n\r\f\x0b]+'))), 6) AS v FROM documents WHERE text IS NOT NULL), o AS (SELECT v, row_number() OVER (ORDER BY v) AS rn, count(*) OVER () AS n FROM f)
SELECT min(CASE WHEN rn = CAST(round_even((n - 1) * 0.1, 0) AS BIGINT) + 1 THEN v END) AS p10, min(CASE WHEN rn = CAST(round_even((n - 1) * 0.5, 0) AS BIGINT) + 1 THEN v END) AS p50, min(CASE WHEN rn = CAST(round_even((n - 1) * 0.9, 0) AS BIGINT) + 1 THEN v END) AS p90,
 round(avg(CASE WHEN v < 3 THEN 1 ELSE 0 END), 6) AS split_share, min(CASE WHEN rn = CAST(round_even((n - 1) * 0.5, 0) AS BIGINT) + 1 THEN v END) < 3 AS extend FROM o""")
def fertility_quantiles(s, d):
    """Characters per white-space token: quantiles, the share of texts with short tokens, and whether to extend."""
    n = F.greatest(F.lit(1), text.count_of(F.col("text"), r"\S+"))
    t = corpus.docs(s, d).where("text is not null").select(F.round(F.length("text") / n, 6).alias("v"))
    p = quantiles.percentiles(t, F.col("v"), [0.1, 0.5, 0.9], "round")
    one = t.agg(F.round(F.avg((F.col("v") < 3).cast("int")), 6).alias("split_share"))
    return p.join(F.broadcast(one)).select("p10", "p50", "p90", "split_share", (F.col("p50") < 3).alias("extend"))  # one row


@query("auc_gate", f"SELECT auc, auc >= 0.80 AND auc < 0.99 AS ok FROM ({audit.QUERIES['auc_rank_sum'][1]})")
def auc_gate(s, d):
    return audit.auc_rank_sum(s, d).select("auc", ((F.col("auc") >= 0.80) & (F.col("auc") < 0.99)).alias("ok"))


# Bounds of a fingerprint, as pattern -> (least, most) share of texts.
_PRINT = {"initials": ("[ㄱ-ㅎ]{2,}", 0.0, 0.35), "laugh": ("ㅋㅋ|ㅎㅎ", 0.05, 0.5), "cry": "", "question": (r"\?", 0.0, 0.31), "ellipsis": (r"\.{2,}|…", 0.05, 0.4), "polite": ("(?:요|니다)[.!?~]*$", 0.1, 0.9)}
_PRINT["cry"] = ("ㅠ|ㅜ", 0.02, 0.3)


@query("fingerprint", " UNION ALL ".join(f"SELECT '{k}' AS marker, round(avg(CASE WHEN regexp_matches(text, '{p}') THEN 1 ELSE 0 END), 6) AS rate, CAST({lo} AS DOUBLE) AS least, CAST({hi} AS DOUBLE) AS most, round(avg(CASE WHEN regexp_matches(text, '{p}') THEN 1 ELSE 0 END), 6) BETWEEN {lo} AND {hi} AS ok FROM valid WHERE text IS NOT NULL" for k, (p, lo, hi) in _PRINT.items()))
def fingerprint(s, d):
    """Rates of markers within bands, in one pass."""
    one = table(s, d, "valid", "text").where("text is not null").agg(*[F.round(F.avg(F.col("text").rlike(p).cast("int")), 6).alias(k) for k, (p, _, _) in _PRINT.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("marker"), F.col(k).alias("rate"), F.lit(float(lo)).alias("least"), F.lit(float(hi)).alias("most")) for k, (_, lo, hi) in _PRINT.items()])
    return one.select(F.inline(rows)).withColumn("ok", F.col("rate").between(F.col("least"), F.col("most")))


@query("vocab_ranked", f"""
WITH c AS ({audit.QUERIES['vocab_candidates'][1]}), k AS (SELECT g AS term, score, g IN ('쿠폰', '셔츠') AS seed FROM c)
SELECT term, score, seed FROM k ORDER BY seed DESC, length(term) DESC, score DESC, term LIMIT 50""")
def vocab_ranked(s, d):
    """The report of the best candidates: forced seeds first, then by length and score."""
    k = audit.vocab_candidates(s, d).select(F.col("g").alias("term"), "score", F.col("g").isin("쿠폰", "셔츠").alias("seed"))
    return k.orderBy(F.desc("seed"), F.desc(F.length("term")), F.desc("score"), "term").limit(50)


@query("depth_markers", rf"SELECT DISTINCT '<comment depth=' || CAST(least(len(string_split(regexp_extract(output, '^{S}*\[([0-9]+(?:-[0-9]+)*)\]', 1), '-')), 4) AS VARCHAR) || '>' AS marker FROM {T} WHERE regexp_matches(output, '^{S}*\[[0-9]+(?:-[0-9]+)*\]')")
def depth_markers(s, d):
    """The depth markers the outputs call for."""
    p = text.reply_parts(F.col("output"))
    t = sft(s, d, "output").where(p["key"].isNotNull())
    return t.select(F.concat(F.lit("<comment depth="), F.least(p["segments"], F.lit(4)).cast("string"), F.lit(">")).alias("marker")).distinct()


# masking variants, flags and maps


@query("pii_doc_variants", "SELECT valid_id, regexp_replace(regexp_replace(text, '" + packs.ADDRESS.replace(r"\s", S) + "', '[주소]', 'g'), '" + packs.CHAT_ID.replace(r"\s", S) + "', '[메신저]', 'g') AS masked FROM valid")
def pii_doc_variants(s, d):
    """Street addresses and messenger names with a handle."""
    t = F.regexp_replace(F.regexp_replace("text", packs.ADDRESS, "[주소]"), packs.CHAT_ID, "[메신저]")
    return table(s, d, "valid", "valid_id", "text").select("valid_id", t.alias("masked"))


_DIGITS = " + ".join(f"CAST(x[{i + 1 + (i >= 6)}] AS INTEGER) * {w}" for i, w in enumerate((2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5)))


@query("pii_rrn_checked", f"""
WITH t AS (SELECT 'valid' AS table_name, valid_id AS id, text FROM valid UNION ALL SELECT 'phase1', record_id, text FROM phase1_data_pipeline)
SELECT table_name, id, list_reduce(list_concat([text], regexp_extract_all(text, '{packs.RRN}')), lambda t, x: CASE WHEN (11 - ({_DIGITS}) % 11) % 10 = CAST(x[14] AS INTEGER) THEN replace(t, x, '[주민번호]') ELSE t END) AS masked FROM t WHERE text IS NOT NULL""")
def pii_rrn_checked(s, d):
    """Resident numbers masked where the check digit holds, and left where it does not."""
    u = table(s, d, "valid", "valid_id", "text").select(F.lit("valid").alias("table_name"), F.col("valid_id").alias("id"), "text")
    u = u.unionByName(table(s, d, "phase1_data_pipeline", "record_id", "text").select(F.lit("phase1").alias("table_name"), F.col("record_id").alias("id"), "text"))
    return u.where("text is not null").select("table_name", "id", scrub.scrub_checked(F.col("text")).alias("masked"))


@query("strata_by_three", """
SELECT doc_id, source, length_bucket, viral FROM (SELECT doc_id, source, length_bucket, length(text) > 200 AS viral, row_number() OVER (PARTITION BY source, length_bucket, length(text) > 200 ORDER BY sha1(CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents) WHERE rn <= 5""")
def strata_by_three(s, d):
    """Five texts of every source, length bucket and side of 200 characters."""
    t = table(s, d, "documents", "doc_id", "source", "length_bucket", "text").select("doc_id", "source", "length_bucket", (F.length("text") > 200).alias("viral"))
    return sampling.stratified(t, ["source", "length_bucket", "viral"], F.struct(F.sha1(F.col("doc_id").cast("string")), "doc_id"), 5).select("doc_id", "source", "length_bucket", "viral")


@query("phone_variants", " UNION ALL ".join(f"SELECT '{k}' AS variant, count(*) FILTER (regexp_matches(text, '{p}')) AS rows FROM valid" for k, p in packs.PHONES.items()))
def phone_variants(s, d):
    one = table(s, d, "valid", "text").agg(*[F.count_if(F.col("text").rlike(p)).alias(k) for k, p in packs.PHONES.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("variant"), F.col(k).alias("rows")) for k in packs.PHONES])))


_NAMES = ["a/.env", "a/.env.local", "b/id_rsa", "b/id_rsa.pub", "c/credentials.json", "c/key.pem", "d/report.md", "d/environment.md"]


@query("secret_file_names", "SELECT name, regexp_matches(name, '" + packs.SECRET_FILES + "') AS blocked FROM (VALUES " + ", ".join(f"('{n}')" for n in _NAMES) + ") v(name)")
def secret_file_names(s, d):
    """File names that must not be published, over a list of names."""
    return s.createDataFrame([(n,) for n in _NAMES], "name string").select("name", F.col("name").rlike(packs.SECRET_FILES).alias("blocked"))


@query("safety_flags", f"SELECT regexp_matches(text, '{packs.SECRET.replace(chr(92) + 's', S)}') AS secret, regexp_matches(text, '{filters.near_pattern(packs.MINOR, packs.SEXUAL)}') AS near, regexp_matches(text, '{'|'.join(packs.FORMAL_AI)}') AS formal, regexp_matches(text, '{_AD}') AS ad, count(*) AS rows FROM documents WHERE text IS NOT NULL GROUP BY 1, 2, 3, 4")
def safety_flags(s, d):
    """Documents by the flags of four filters that few or none of the test texts call for."""
    c = F.col("text")
    flags = {"secret": c.rlike(packs.SECRET), "near": filters.proximity(c, packs.MINOR, packs.SEXUAL), "formal": c.rlike("|".join(packs.FORMAL_AI)), "ad": c.rlike("(?i)(?:" + packs.AD + ")")}
    return corpus.docs(s, d).where("text is not null").groupBy(*[x.alias(k) for k, x in flags.items()]).agg(F.count("*").alias("rows"))


@query("maps_overlaid", "SELECT id, coalesce(tone, '혼용') AS tone, coalesce(mood, 'neutral') AS mood, 3 AS keys, '1' AS version FROM persona_list")
def maps_overlaid(s, d):
    """Defaults with what a persona gives laid over them."""
    base = F.create_map(F.lit("tone"), F.lit("혼용"), F.lit("mood"), F.lit("neutral"), F.lit("version"), F.lit("1"))
    m = text.overlay(base, F.create_map(F.lit("tone"), F.col("tone"), F.lit("mood"), F.col("mood")))
    p = table(s, d, "persona_list", "id", "tone", "mood").select("id", m.alias("m"))
    return p.select("id", F.element_at("m", "tone").alias("tone"), F.element_at("m", "mood").alias("mood"), F.size("m").alias("keys"), F.element_at("m", "version").alias("version"))


QUERIES = Q
