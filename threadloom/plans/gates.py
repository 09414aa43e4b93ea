"""Gates and verifiers as long tables: one row per check, with its value, its bound and whether it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import packs, text
from ..operators import filters, metrics, rules
from ..session import table
from . import audit

Q: dict = {}
T = "round2_build_tc_sft"
S = r"[ \t\n\r\f\x0b]"


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def _strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{text.WS}+|{text.WS}+$', '', 'g')"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _measured(s, d, names: dict[str, tuple[str, str]]) -> DataFrame:
    """``(metric, value)``: one column of each of these one-row queries."""
    return _union([audit.QUERIES[q][0](s, d).select(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, (q, c) in names.items()])


def _measured_sql(names: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({c} AS DOUBLE) AS value FROM ({audit.QUERIES[q][1]}) AS q_{m}" for m, (q, c) in names.items())


def _gate_sql(values: str, gate: dict[str, tuple[str, float]]) -> str:
    rows = ", ".join(f"('{k}', '{op}', {v}::DOUBLE)" for k, (op, v) in gate.items())
    ok = "CASE WHEN op = 'le' THEN value <= threshold ELSE value >= threshold END"
    return f"""
WITH v AS ({values}), t(metric, op, threshold) AS (VALUES {rows}), j AS (SELECT t.metric, v.value, t.op, t.threshold FROM t LEFT JOIN v USING (metric))
SELECT metric, value, op, threshold, CASE WHEN value IS NULL THEN 'value_unavailable' WHEN NOT ({ok}) THEN 'out_of_bounds' WHEN metric = 'mauve_score' AND value > 0.99 THEN 'too_good' END AS violation FROM j"""


_BASE = {
    "bigram_jsd": ("bigram_jsd_splits", "jsd"),
    "length_kl": ("length_kl", "kl"),
    "digit_density_delta": ("density_delta", "digit_delta"),
    "english_density_delta": ("density_delta", "english_delta"),
    "domain_keyword_alignment": ("presence_alignment", "alignment"),
    "tone_distribution_match": ("tone_match", "tone_delta"),
}
_V2 = {
    "punct_ratio_match": ("punct_match", "worst"),
    "initial_marker_match": ("initial_match", "worst"),
    "reply_depth_kl": ("reply_depth_kl", "kl"),
    "persona_consistency": ("persona_share", "consistency"),
    "agreement_jsd": ("bigram_jsd_halves", "jsd"),
}


@query("gate_eval_long", _gate_sql(_measured_sql(_BASE), packs.GATE))
def gate_eval_long(s, d):
    """Seven thresholds between the splits; what was not measured (the semantic score needs a GPU) is a violation."""
    return metrics.gate(_measured(s, d, _BASE), packs.GATE)


@query("gate_v2_long", _gate_sql(_measured_sql(_V2), packs.GATE_V2))
def gate_v2_long(s, d):
    return metrics.gate(_measured(s, d, _V2), packs.GATE_V2)


@query("gate_verdicts", f"""
SELECT 'base' AS gate, CASE WHEN count(violation) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict, count(violation) AS violations FROM ({Q['gate_eval_long'][1]})
UNION ALL SELECT 'v2', CASE WHEN count(violation) = 0 THEN 'PASS' ELSE 'FAIL' END, count(violation) FROM ({Q['gate_v2_long'][1]})
UNION ALL SELECT 'samples', CASE WHEN min(n) >= 20 AND max(n) = min(n) THEN 'PASS' ELSE 'FAIL' END, CAST(sum(CASE WHEN n < 20 THEN 1 ELSE 0 END) + CASE WHEN max(n) <> min(n) THEN 1 ELSE 0 END AS BIGINT) FROM (SELECT count(*) AS n FROM {T} WHERE output IS NOT NULL GROUP BY split)""")
def gate_verdicts(s, d):
    """Both gates in one row each, and whether the two sides are large enough and of one size."""
    verdict = lambda name, g: g.agg(F.count("violation").alias("violations")).select(F.lit(name).alias("gate"), F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("verdict"), "violations")
    n = table(s, d, T, "split", "output").where("output is not null").groupBy("split").agg(F.count("*").alias("n"))
    n = n.agg((F.sum((F.col("n") < 20).cast("long")) + (F.max("n") != F.min("n")).cast("long")).alias("violations"))
    n = n.select(F.lit("samples").alias("gate"), F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("verdict"), "violations")
    return _union([verdict("base", gate_eval_long(s, d)), verdict("v2", gate_v2_long(s, d)), n])


# the verifier of datasets: (table, text column, required columns)
_SETS = [("documents", "text", ["text", "kind", "source"]), (T, "output", ["instruction", "input", "output", "persona_id", "loss_weight"]), ("valid", "text", ["text"])]
_SEVERE = {"missing_required": 0.0, "phone_like": 0.0, "email_like": 0.0, "rrn_like": 0.0, "proximity": 0.0, "replaced": 0.0}


def _verified_sql() -> str:
    rrn = packs.RRN
    parts = []
    for t, c, req in _SETS:
        parts.append(f"""
SELECT '{t}' AS table_name, count(*) AS n, count(*) FILTER ({_strip_sql(c)} <> '') AS full, count(DISTINCT nullif({_strip_sql(c)}, '')) AS distinct_texts,
 count(*) FILTER ({' OR '.join(f'{x} IS NULL' for x in req)}) AS missing_required, count(*) FILTER (regexp_matches({c}, '{packs.PHONE}')) AS phone_like, count(*) FILTER (regexp_matches({c}, '{packs.EMAIL}')) AS email_like, count(*) FILTER (regexp_matches({c}, '{rrn}')) AS rrn_like,
 count(*) FILTER (regexp_matches({c}, '{filters.near_pattern(packs.MINOR, packs.SEXUAL)}')) AS proximity, count(*) FILTER (contains({c}, chr(65533))) AS replaced, count(*) FILTER (length({_strip_sql(c)}) BETWEEN 1 AND 19) AS short,
 sum(len(regexp_extract_all({c}, '[가-힣]'))) / sum(length({c})) AS hangul, sum(len(regexp_extract_all({c}, '[一-鿿]'))) / sum(length({c})) AS cjk FROM {t}""")
    long = " UNION ALL ".join(f"SELECT table_name, '{k}' AS check_name, {e} AS value FROM v" for k, e in _CHECKS_SQL.items())
    return f"WITH v AS ({' UNION ALL '.join(parts)}), l AS ({long}) SELECT table_name, check_name, round(value, 6) AS value, {_LEVEL_SQL} AS level FROM l"


_CHECKS_SQL = {
    "rows": "CAST(n AS DOUBLE)",
    **{k: f"CAST({k} AS DOUBLE)" for k in _SEVERE},
    "mojibake": "CASE WHEN hangul < 0.15 AND cjk > 0.10 THEN 1.0 ELSE 0.0 END",
    "duplicate_rate": "CASE WHEN \"full\" > 0 THEN (\"full\" - distinct_texts) / \"full\" ELSE 0.0 END",
    "short_share": "CASE WHEN \"full\" > 0 THEN short / \"full\" ELSE 0.0 END",
}
_LEVEL_SQL = """CASE WHEN check_name = 'rows' THEN CASE WHEN value = 0 THEN 'severe' ELSE 'ok' END WHEN check_name = 'duplicate_rate' THEN CASE WHEN value > 0.5 THEN 'severe' WHEN value > 0.35 THEN 'warn' ELSE 'ok' END
 WHEN check_name = 'short_share' THEN CASE WHEN value > 0.2 THEN 'warn' ELSE 'ok' END WHEN value > 0 THEN 'severe' ELSE 'ok' END"""


@query("dataset_verifier", _verified_sql().replace(r"[-\s]", r"[- \t\n\r\f\x0b]").replace(" AS full,", ' AS "full",'))
def dataset_verifier(s, d):
    """Three tables: rows, required columns, personal data that remains, encoding, duplicates and short texts, each with
    its level. One aggregation per table."""
    parts = []
    for t, c, req in _SETS:
        x, full = F.col(c), text.strip(F.coalesce(F.col(c), F.lit("")))
        count = lambda p: F.count_if(F.coalesce(p, F.lit(False))).cast("double")
        one = table(s, d, t, *dict.fromkeys([c, *req])).agg(
            F.count("*").cast("double").alias("rows"),
            count(full != "").alias("_full"),
            F.count_distinct(F.when(full != "", full)).alias("_distinct"),
            count(reduce(lambda a, b: a | b, [F.col(r).isNull() for r in req])).alias("missing_required"),
            count(x.rlike(packs.PHONE)).alias("phone_like"),
            count(x.rlike(packs.EMAIL)).alias("email_like"),
            count(x.rlike(packs.RRN)).alias("rrn_like"),
            count(filters.proximity(x, packs.MINOR, packs.SEXUAL)).alias("proximity"),
            count(F.contains(x, F.lit("�"))).alias("replaced"),
            count((full != "") & (F.length(full) < 20)).alias("_short"),
            (F.sum(text.count_of(x, "[가-힣]")) / F.sum(F.length(x))).alias("_hangul"),
            (F.sum(text.count_of(x, "[一-鿿]")) / F.sum(F.length(x))).alias("_cjk"),
        )
        share = lambda n: F.when(F.col("_full") > 0, n / F.col("_full")).otherwise(0.0)
        values = {k: F.col(k) for k in ["rows", *_SEVERE]} | {
            "mojibake": F.when((F.col("_hangul") < 0.15) & (F.col("_cjk") > 0.10), 1.0).otherwise(0.0),
            "duplicate_rate": share(F.col("_full") - F.col("_distinct")),
            "short_share": share(F.col("_short")),
        }
        parts.append(one.select(F.lit(t).alias("table_name"), F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), v.alias("value")) for k, v in values.items()])).alias("r")).select("table_name", "r.*"))
    v, k = F.col("value"), F.col("check_name")
    level = (
        F.when(k == "rows", F.when(v == 0, "severe").otherwise("ok"))
        .when(k == "duplicate_rate", F.when(v > 0.5, "severe").when(v > 0.35, "warn").otherwise("ok"))
        .when(k == "short_share", F.when(v > 0.2, "warn").otherwise("ok"))
        .otherwise(F.when(v > 0, "severe").otherwise("ok"))
    )
    return _union(parts).select("table_name", "check_name", F.round("value", 6).alias("value"), level.alias("level"))


@query("dataset_verdicts", f"SELECT table_name, CASE WHEN bool_or(level = 'severe') THEN 'FAIL' WHEN bool_or(level = 'warn') THEN 'WARN' ELSE 'PASS' END AS verdict FROM ({Q['dataset_verifier'][1]}) GROUP BY table_name")
def dataset_verdicts(s, d):
    v = dataset_verifier(s, d).groupBy("table_name")
    return v.agg(F.when(F.bool_or(F.col("level") == "severe"), "FAIL").when(F.bool_or(F.col("level") == "warn"), "WARN").otherwise("PASS").alias("verdict"))


_FULL = {c: f"coalesce({_strip_sql(c)}, '') <> ''" for c in ("instruction", "output")}


@query("integrity_check", f"""
WITH t AS (SELECT * FROM {T} WHERE split = 'train'), e AS (SELECT * FROM {T} WHERE split = 'eval'),
a AS (SELECT count(*) AS n, count(*) FILTER (NOT ({_FULL['instruction']} AND {_FULL['output']})) AS bad, count(*) FILTER (loss_weight > 1) AS weighted, count(persona_id) / count(*) AS persona FROM t),
held AS (SELECT trim(text) AS x FROM valid WHERE text IS NOT NULL UNION SELECT trim(output) FROM e WHERE output IS NOT NULL),
c(check_name, value, op, threshold) AS (
 SELECT 'train_rows', CAST(n AS DOUBLE), 'ge', 8000.0 FROM a UNION ALL SELECT 'eval_rows', CAST(count(*) AS DOUBLE), 'ge', 100.0 FROM e UNION ALL SELECT 'malformed', CAST(bad AS DOUBLE), 'le', 0.0 FROM a
 UNION ALL SELECT 'weighted', CAST(weighted AS DOUBLE), 'ge', 1.0 FROM a UNION ALL SELECT 'persona_coverage', round(persona, 6), 'ge', 0.95 FROM a
 UNION ALL SELECT 'held_out_outputs', CAST(count(*) AS DOUBLE), 'le', 0.0 FROM t WHERE trim(output) IN (SELECT x FROM held)
 UNION ALL SELECT 'roots_in_eval', CAST(count(*) AS DOUBLE), 'le', 0.0 FROM (SELECT root_id FROM t WHERE root_id IS NOT NULL INTERSECT SELECT root_id FROM e)
 UNION ALL SELECT 'roots_in_valid', CAST(count(*) AS DOUBLE), 'le', 0.0 FROM (SELECT root_id FROM t WHERE root_id IS NOT NULL INTERSECT SELECT source_id FROM valid))
SELECT check_name, value, op, CAST(threshold AS DOUBLE) AS threshold, CASE WHEN op = 'ge' THEN value >= threshold ELSE value <= threshold END AS ok FROM c""")
def integrity_check(s, d):
    """Row minimums, malformed rows, coverage, held-out outputs in training, and thread intersections."""
    r = table(s, d, T, "split", "instruction", "output", "root_id", "persona_id", "loss_weight")
    t, e = r.where("split = 'train'"), r.where("split = 'eval'")
    v = table(s, d, "valid", "text", "source_id")
    full = lambda c: text.strip(F.coalesce(F.col(c), F.lit(""))) != ""
    row = lambda df, name, value, op, bound: df.select(F.lit(name).alias("check_name"), value.cast("double").alias("value"), F.lit(op).alias("op"), F.lit(float(bound)).alias("threshold"))
    a = t.agg(F.count("*").alias("n"), F.count_if(~(full("instruction") & full("output"))).alias("bad"), F.count_if(F.col("loss_weight") > 1).alias("w"), F.round(F.count("persona_id") / F.count("*"), 6).alias("p"))
    h = lambda df, c: df.where(F.col(c).isNotNull()).select(F.sha2(F.trim(c), 256).alias("h"))
    leaked = h(t, "output").join(h(v, "text").unionByName(h(e, "output")), "h", "left_semi")
    roots = lambda df, c: df.where(F.col(c).isNotNull()).select(F.col(c).alias("root"))
    n = F.count("*")
    out = _union([
        row(a, "train_rows", F.col("n"), "ge", 8000), row(e.agg(n.alias("n")), "eval_rows", F.col("n"), "ge", 100), row(a, "malformed", F.col("bad"), "le", 0), row(a, "weighted", F.col("w"), "ge", 1), row(a, "persona_coverage", F.col("p"), "ge", 0.95),
        row(leaked.agg(n.alias("n")), "held_out_outputs", F.col("n"), "le", 0),
        row(roots(t, "root_id").intersect(roots(e, "root_id")).agg(n.alias("n")), "roots_in_eval", F.col("n"), "le", 0),
        row(roots(t, "root_id").intersect(roots(v, "source_id")).agg(n.alias("n")), "roots_in_valid", F.col("n"), "le", 0),
    ])
    return out.withColumn("ok", F.when(F.col("op") == "ge", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold")))


@query("eval_minimum", f"""
WITH a AS (SELECT * FROM valid v WHERE NOT EXISTS (SELECT 1 FROM documents x WHERE trim(x.text) = trim(v.text)) AND NOT EXISTS (SELECT 1 FROM {T} r WHERE r.split = 'train' AND trim(r.output) = trim(v.text))),
b AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM {T} r WHERE r.split = 'train' AND r.root_id = a.source_id))
SELECT (SELECT count(*) FROM valid) AS before, (SELECT count(*) FROM a) AS after_texts, count(*) AS after_threads, count(*) >= 100 AS ok FROM b""")
def eval_minimum(s, d):
    """Held-out rows left after the removal of equal texts and of threads in training, and whether 100 are left."""
    v = table(s, d, "valid", "text", "source_id").withColumn("h", F.sha2(F.trim("text"), 256))
    r = table(s, d, T, "split", "output", "root_id").where("split = 'train'")
    h = lambda df, c: df.select(F.sha2(F.trim(c), 256).alias("h")).where("h is not null")
    a = v.join(h(audit.docs(s, d), "text").unionByName(h(r, "output")), "h", "left_anti")
    b = a.join(r.select(F.col("root_id").alias("source_id")), "source_id", "left_anti")
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(v, "before").join(F.broadcast(n(a, "after_texts"))).join(F.broadcast(n(b, "after_threads"))).withColumn("ok", F.col("after_threads") >= 100)  # one row each


@query("rules_fired", f"""
WITH v AS (SELECT max(value) FILTER (metric = 'bigram_jsd') AS jsd, max(value) FILTER (metric = 'length_kl') AS kl, max(value) FILTER (metric = 'digit_density_delta') AS dg, max(value) FILTER (metric = 'english_density_delta') AS en FROM ({_measured_sql(_BASE)})),
w AS (SELECT max(value) FILTER (metric = 'domain_keyword_alignment') AS al FROM ({_measured_sql(_BASE)})), u AS (SELECT max(value) FILTER (metric = 'reply_depth_kl') AS dk, max(value) FILTER (metric = 'persona_consistency') AS pc, max(value) FILTER (metric = 'punct_ratio_match') AS pr, max(value) FILTER (metric = 'initial_marker_match') AS im FROM ({_measured_sql(_V2)}))
SELECT 'base' AS rules, CASE WHEN jsd > 0.15 THEN 'R1' WHEN kl > 0.10 THEN 'R2' WHEN dg > 0.03 OR en > 0.02 THEN 'R3'
 WHEN CAST(jsd > 0.135 AND jsd <= 0.15 AS INTEGER) + CAST(kl > 0.09 AND kl <= 0.10 AS INTEGER) + CAST(dg > 0.027 AND dg <= 0.03 AS INTEGER) + CAST(en > 0.018 AND en <= 0.02 AS INTEGER) >= 3 THEN 'R5' ELSE 'R6' END AS fired FROM v
UNION ALL SELECT 'v2', CASE WHEN al < 0.40 THEN 'R7' WHEN dk > 0.20 THEN 'R8' WHEN pc < 0.75 THEN 'R9' WHEN pr > 0.20 THEN 'R10' WHEN im > 0.25 THEN 'R11' ELSE 'R7-R11_NOOP' END FROM w, u""")
def rules_fired(s, d):
    """The first rule of each table that the measured metrics call for, from a recipe nothing was changed in."""
    base = {r.metric: r.value for r in _measured(s, d, _BASE).collect()}  # six numbers
    v2 = {r.metric: r.value for r in _measured(s, d, _V2).collect()}  # five numbers
    fired = [("base", rules.first_match(base, rules.State()).name), ("v2", rules.first_match(base | v2, rules.State(), rules.RULES_V2).name)]
    return s.createDataFrame(fired, "rules string, fired string")


QUERIES = Q
