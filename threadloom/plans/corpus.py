"""Text, masking, filter, deduplication and leak queries over documents, valid and round2_build_tc_sft."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import packs, scrub, text
from ..operators import dedup, filters
from ..session import table

Q: dict = {}


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def docs(s, d, *extra):
    return table(s, d, "documents", "doc_id", "text", *extra)


_A = "CASE WHEN length({t}) < 20 THEN 'xs' WHEN length({t}) < 50 THEN 'sm' WHEN length({t}) < 100 THEN 'md' WHEN length({t}) < 200 THEN 'lg' WHEN length({t}) < 500 THEN 'xl' ELSE 'xxl' END"
_WS = "trim(regexp_replace({t}, '" + text.WS.replace("{", "{{").replace("}", "}}") + "+', ' ', 'g'))"


# T: scalar text functions


@query("norm_ws_dedup_exact", f"""
WITH c AS (SELECT doc_id, {_WS.format(t='text')} AS t FROM documents), f AS (SELECT * FROM c WHERE length(t) >= 10),
k AS (SELECT t, min(doc_id) AS doc_id FROM f GROUP BY t)
SELECT {_A.format(t='t')} AS bucket, count(*) AS docs, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM k GROUP BY 1""")
def norm_ws_dedup_exact(s: SparkSession, d: str) -> DataFrame:
    t = docs(s, d).select("doc_id", text.collapse(F.col("text")).alias("t")).where(F.length("t") >= 10)
    k = dedup.first_wins(t, [F.col("t")], "doc_id")
    g = k.groupBy(text.bucket_a(F.col("t")).alias("bucket")).agg(F.count("*").alias("docs"))
    total = g.agg(F.sum("docs").alias("all"))
    return g.join(F.broadcast(total)).select("bucket", "docs", F.round(F.col("docs") / F.col("all"), 6).alias("share"))


@query("canonical_text", r"""
SELECT row_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\][ \t\n\r\f\x0b]*', ''),
 'https?://[^ \t\n\r\f\x0b]+', '[URL]', 'g'), '01[016789][- .]?[0-9]{3,4}[- .]?[0-9]{4}', '[전화번호]', 'g'), '@WS@+', ' ', 'g'))) AS canon
FROM round2_build_tc_sft WHERE output IS NOT NULL""".replace("@WS@", text.WS))
def canonical_text(s, d):
    return table(s, d, "round2_build_tc_sft", "row_id", "output").where("output is not null").select("row_id", text.canonical(F.col("output")).alias("canon"))


@query("length_buckets", f"""
SELECT {_A.format(t='text')} AS bucket_a, CASE WHEN length(trim(text)) < 40 THEN 'xs' WHEN length(trim(text)) < 80 THEN 'sm' WHEN length(trim(text)) < 160 THEN 'md' ELSE 'lg' END AS bucket_b, count(*) AS n FROM valid GROUP BY 1, 2""")
def length_buckets(s, d):
    return table(s, d, "valid", "text").groupBy(text.bucket_a(F.col("text")).alias("bucket_a"), text.bucket_b(F.col("text")).alias("bucket_b")).agg(F.count("*").alias("n"))


@query("length_hist14", """
WITH e(i, top) AS (VALUES (0,0),(1,10),(2,20),(3,35),(4,60),(5,100),(6,160),(7,260),(8,400),(9,600),(10,900),(11,1400),(12,2200)),
b AS (SELECT coalesce((SELECT min(i) FROM e WHERE length(text) <= top), 13) AS bin FROM documents)
SELECT CAST(r.i AS INTEGER) AS bin, count(b.bin) AS n FROM range(14) r(i) LEFT JOIN b ON b.bin = r.i GROUP BY r.i""")
def length_hist14(s, d):
    h = docs(s, d).groupBy(text.bin14(F.col("text")).alias("bin")).agg(F.count("*").alias("n"))
    bins = s.range(14).select(F.col("id").cast("int").alias("bin"))
    return bins.join(h, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query("excerpts", """
SELECT doc_id, CASE WHEN length(trim(text)) > 256 THEN rtrim(trim(text)[1:256]) || '...' ELSE trim(text) END AS excerpt FROM documents""")
def excerpts(s, d):
    return docs(s, d).select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


@query("char_class_density", r"""
SELECT source, round(avg(len(regexp_extract_all(text, '[가-힣]')) / length(text)), 6) AS hangul, round(avg(len(regexp_extract_all(text, '[ㄱ-ㅎㅏ-ㅣ]')) / length(text)), 6) AS jamo,
 round(avg(len(regexp_extract_all(text, '[0-9]')) / length(text)), 6) AS digit, round(avg(len(regexp_extract_all(text, '[A-Za-z]')) / length(text)), 6) AS english,
 round(avg(len(regexp_extract_all(text, '[ \t\n\r\f\x0b]')) / length(text)), 6) AS ws
FROM documents WHERE length(text) > 0 GROUP BY source""")
def char_class_density(s, d):
    c = F.col("text")
    kinds = {"hangul": "[가-힣]", "jamo": "[ㄱ-ㅎㅏ-ㅣ]", "digit": "[0-9]", "english": "[A-Za-z]", "ws": r"\s"}
    return docs(s, d, "source").where(F.length(c) > 0).groupBy("source").agg(*[F.round(F.avg(text.density(c, p)), 6).alias(k) for k, p in kinds.items()])


@query("digit_english_rich", """
SELECT doc_id FROM documents WHERE length(text) > 0 AND (len(regexp_extract_all(text, '[0-9]')) / length(text) > 0.08 OR len(regexp_extract_all(text, '[A-Za-z]')) / length(text) > 0.02)""")
def digit_english_rich(s, d):
    c = F.col("text")
    return docs(s, d).where((text.density(c, "[0-9]") > 0.08) | (text.density(c, "[A-Za-z]") > 0.02)).select("doc_id")


@query("repeat_runs", r"""
SELECT valid_id, len(regexp_extract_all(text, 'ㄱㄱ+|ㄴㄴ+|ㄷㄷ+|ㅇㅇ+|ㅋㅋ+|ㅎㅎ+|ㅠㅠ+|ㅜㅜ+')) AS jamo_runs, len(regexp_extract_all(text, '\?\?+|!!+|\.\.+|~~+')) AS punct_runs FROM valid""")
def repeat_runs(s, d):
    # a back-reference would do; the alternation means the same and also runs in engines without them
    return table(s, d, "valid", "valid_id", "text").select(
        "valid_id",
        F.regexp_count("text", F.lit("ㄱㄱ+|ㄴㄴ+|ㄷㄷ+|ㅇㅇ+|ㅋㅋ+|ㅎㅎ+|ㅠㅠ+|ㅜㅜ+")).cast("long").alias("jamo_runs"),
        F.regexp_count("text", F.lit(r"\?\?+|!!+|\.\.+|~~+")).cast("long").alias("punct_runs"),
    )


@query("encoding_profile", """
SELECT source, CAST(sum(len(regexp_extract_all(text, '[가-힣]'))) AS BIGINT) AS hangul, CAST(sum(len(regexp_extract_all(text, '[一-鿿]'))) AS BIGINT) AS cjk, CAST(sum(length(text) - length(replace(text, chr(65533), ''))) AS BIGINT) AS replaced FROM documents GROUP BY source""")
def encoding_profile(s, d):
    c = F.col("text")
    return docs(s, d, "source").groupBy("source").agg(F.sum(text.count_of(c, "[가-힣]")).alias("hangul"), F.sum(text.count_of(c, "[一-鿿]")).alias("cjk"), F.sum(text.occurrences(c, "�")).alias("replaced"))


@query("reply_parts", r"""
SELECT row_id, nullif(regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1), '') AS reply_key,
 CASE WHEN regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1) = '' THEN 0 ELSE CAST(len(string_split(regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\]', 1), '-')) AS INTEGER) END AS segments,
 coalesce(TRY_CAST(nullif(regexp_extract(output, '^[ \t\n\r\f\x0b]*\[([0-9]+)-([0-9]+)\]', 2), '') AS INTEGER) + 1, 1) AS index_depth,
 regexp_replace(output, '^[ \t\n\r\f\x0b]*\[([0-9]+(?:-[0-9]+)*)\][ \t\n\r\f\x0b]*', '') AS body
FROM round2_build_tc_sft WHERE output IS NOT NULL""")
def reply_parts(s, d):
    p = text.reply_parts(F.col("output"))
    return table(s, d, "round2_build_tc_sft", "row_id", "output").where("output is not null").select("row_id", p["key"].alias("reply_key"), p["segments"].alias("segments"), p["index"].alias("index_depth"), p["body"].alias("body"))


@query("kind_normalised", """
SELECT kind AS raw_kind, CASE WHEN lower(trim(kind)) IN ('comment', 'context_comment', 'reply', 'comments') THEN 'comment' WHEN lower(trim(kind)) IN ('post', 'context_post', 'post_title', 'article') THEN 'post' END AS kind, count(*) AS n FROM documents GROUP BY 1, 2""")
def kind_normalised(s, d):
    return table(s, d, "documents", "kind").groupBy(F.col("kind").alias("raw_kind"), text.kind_of(F.col("kind")).alias("kind")).agg(F.count("*").alias("n")).select("raw_kind", "kind", "n")


@query("falsy_text", """
SELECT record_id, coalesce(CASE WHEN trim(post_body_clean) <> '' THEN post_body_clean END, CASE WHEN trim(post_title_clean) <> '' THEN post_title_clean END, CASE WHEN trim(text) <> '' THEN text END) AS picked FROM phase1_data_pipeline""")
def falsy_text(s, d):
    return table(s, d, "phase1_data_pipeline", "record_id", "post_body_clean", "post_title_clean", "text").select("record_id", text.falsy(F.col("post_body_clean"), F.col("post_title_clean"), F.col("text")).alias("picked"))


@query("persona_numbers", """
SELECT row_id, TRY_CAST(nullif(regexp_extract(lower(trim(persona_id)), '^p?-?0*([0-9]+)$', 1), '') AS INTEGER) AS persona FROM round2_build_tc_sft WHERE persona_id IS NOT NULL""")
def persona_numbers(s, d):
    return table(s, d, "round2_build_tc_sft", "row_id", "persona_id").where("persona_id is not null").select("row_id", text.persona_number(F.col("persona_id")).alias("persona"))


@query("approx_tokens", "SELECT doc_id, CAST(greatest(1, round_even(length(text) / 2.2, 0)) AS INTEGER) AS tokens FROM documents")
def approx_tokens(s, d):
    return docs(s, d).select("doc_id", text.approx_tokens(F.col("text")).alias("tokens"))


_TONE4 = "CASE WHEN regexp_matches(text, '{0}') THEN '격식' WHEN regexp_matches(text, '{1}') THEN '유머' WHEN regexp_matches(text, '{2}') THEN '감정적' ELSE '일상' END".format(*[p for _, p in packs.TONE4])


@query("tone_4class", f"SELECT {_TONE4} AS tone, count(*) AS docs FROM documents GROUP BY 1")
def tone_4class(s, d):
    return docs(s, d).groupBy(text.tone4(F.col("text")).alias("tone")).agg(F.count("*").alias("docs"))


@query("tone_votes", r"""
WITH v AS (SELECT len(regexp_extract_all(text, '(?m)(합니다|합니까|하세요|하십시오|하시겠|입니다|습니다|습니까|세요|시오|겠습|에요|예요|해요|하죠|죠)[ \t\n\r\f\x0b]*[.?!]?[ \t\n\r\f\x0b]*$')) AS a,
 len(regexp_extract_all(text, '(?m)(해|했|한다|했다|하지|했지|함|했음|인데|인듯|거든|거임|임|음|ㅋ|ㅎ|ㅠ|ㅜ)[ \t\n\r\f\x0b]*[.?!]?[ \t\n\r\f\x0b]*$')) AS b FROM valid)
SELECT CASE WHEN a + b = 0 THEN '혼합' WHEN a / (a + b) > 0.7 THEN '존댓말' WHEN b / (a + b) > 0.7 THEN '반말' ELSE '혼합' END AS tone, count(*) AS n FROM v GROUP BY 1""")
def tone_votes(s, d):
    return table(s, d, "valid", "text").groupBy(text.tone_votes(F.col("text")).alias("tone")).agg(F.count("*").alias("n"))


_TOPICS = " ".join(f"UNION ALL SELECT doc_id, '{k}' FROM documents WHERE regexp_matches(text, '{p}')" for k, p in packs.TOPICS.items())[10:]


@query("topics_multilabel", f"""
WITH h(doc_id, topic) AS ({_TOPICS}), o AS (SELECT doc_id, '기타' AS topic FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM h))
SELECT topic, count(*) AS docs FROM (SELECT * FROM h UNION ALL SELECT * FROM o) GROUP BY topic""")
def topics_multilabel(s, d):
    return docs(s, d).select(F.explode(text.topics(F.col("text"))).alias("topic")).groupBy("topic").agg(F.count("*").alias("docs"))


_ARGOT = packs.TERMS[:12]


@query("loss_weight_terms", f"""
SELECT row_id, CASE WHEN len(list_distinct(list_concat(regexp_extract_all(coalesce(instruction, ''), '{'|'.join(_ARGOT)}'), regexp_extract_all(coalesce(output, ''), '{'|'.join(_ARGOT)}')))) >= 2 THEN 1.5 ELSE 1.0 END::DOUBLE AS weight
FROM round2_build_tc_sft""")
def loss_weight_terms(s, d):
    return table(s, d, "round2_build_tc_sft", "row_id", "instruction", "output").select("row_id", text.loss_weight([F.col("instruction"), F.col("output")], _ARGOT).alias("weight"))


@query("heuristic_ai_score", r"""
WITH x AS (SELECT valid_id, CASE WHEN regexp_matches(trim(text), '(습니다|입니다|하십시오|하도록|겠습니다)$') THEN 2 ELSE 0 END - CASE WHEN regexp_matches(text, 'ㅋㅋ|ㅎㅎ|ㅠㅠ|ㅜㅜ|ㄷㄷ|;;|~~|\.\.\.') THEN 2 ELSE 0 END
 + CASE WHEN contains(text, chr(10)) THEN 1 ELSE 0 END - CASE WHEN length(text) < 40 THEN 1 ELSE 0 END AS score FROM valid)
SELECT valid_id, score, CASE WHEN score >= 1 THEN 'AI' ELSE 'HUMAN' END AS label FROM x""")
def heuristic_ai_score(s, d):
    sc = text.ai_score(F.col("text"))
    return table(s, d, "valid", "valid_id", "text").select("valid_id", sc.alias("score"), F.when(sc >= 1, "AI").otherwise("HUMAN").alias("label"))


@query("hash_functions", """
SELECT doc_id, sha256(text) AS sha256_hex, md5(text) AS md5_hex, sha1(text) AS sha1_hex, CAST((('0x' || sha256(text)[1:16])::UBIGINT % 1000) AS INTEGER) AS h1000 FROM documents""")
def hash_functions(s, d):
    c = F.col("text")
    return docs(s, d).select("doc_id", F.sha2(c, 256).alias("sha256_hex"), F.md5(c).alias("md5_hex"), F.sha1(c).alias("sha1_hex"), text.hash64_mod(c, 1000).alias("h1000"))


@query("dates_parsed", r"""
SELECT record_id, TRY_CAST(regexp_replace(trim(date), 'Z$', '+00:00') AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS at FROM phase1_data_pipeline WHERE regexp_matches(trim(date), '^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})?$')""")
def dates_parsed(s, d):
    p = table(s, d, "phase1_data_pipeline", "record_id", "date").where(F.trim("date").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})?$"))
    return p.select("record_id", text.date_of(F.col("date")).cast("timestamp_ntz").alias("at"))


def _nfkc_sql(c: str) -> str:
    """Compatibility composition in SQL: characters mapped one by one, by the rule of the standard's tables, around the
    engine's canonical composition; then conjoining letters back to stand-alone ones."""
    one, many = {}, []
    for n in (*range(0x80, 0xD800), *range(0xE000, 0x20000)):
        to = unicodedata.normalize("NFKC", chr(n))
        if to != chr(n) and len(to) == 1:
            one[chr(n)] = to
        elif len(to) > 1 and to != chr(n):
            many.append(chr(n) + to)
    q = lambda x: "'" + "".join(x).replace("'", "''") + "'"
    wide = f"list_reduce(list_concat([{c}], [{', '.join(map(q, many))}]), lambda t, x: replace(t, x[1], x[2:]))"
    letters = text.restore_jamo_map()
    return f"translate(nfc_normalize(translate({wide}, {q(one)}, {q(one.values())})), {q(letters[0])}, {q(letters[1])})"


_CONJOINING = "len(regexp_extract_all({c}, '[\\x{{1100}}-\\x{{11FF}}]'))"


@query("nfkc_jamo", f"""
WITH n AS (SELECT valid_id, text, {_nfkc_sql('text')} AS normalised FROM valid)
SELECT valid_id, normalised, CAST({_CONJOINING.format(c='text')} AS INTEGER) AS conjoining_before, CAST({_CONJOINING.format(c='normalised')} AS INTEGER) AS conjoining_after FROM n""")
def nfkc_jamo(s, d):
    """Compatibility composition with stand-alone letters restored, and how many letters changed range."""
    v = table(s, d, "valid", "valid_id", "text").withColumn("n", text.nfkc(F.col("text")))
    return v.select("valid_id", F.col("n").alias("normalised"), text.count_of(F.col("text"), "[\\u1100-\\u11FF]").alias("conjoining_before"), text.count_of(F.col("n"), "[\\u1100-\\u11FF]").alias("conjoining_after"))


# P: masking


@query("pii_email_mask", r"""SELECT valid_id, regexp_replace(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}', '[이메일]', 'g') AS masked FROM valid""")
def pii_email_mask(s, d):
    return table(s, d, "valid", "valid_id", "text").select("valid_id", F.regexp_replace("text", packs.EMAIL, "[이메일]").alias("masked"))


@query("pii_ipv4_mask", r"SELECT valid_id, regexp_replace(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}', '[IP]', 'g') AS masked FROM valid")
def pii_ipv4_mask(s, d):
    return table(s, d, "valid", "valid_id", "text").select("valid_id", F.regexp_replace("text", packs.IPV4, "[IP]").alias("masked"))


def _scrub_sql() -> str:
    with_, prev = [], "(SELECT valid_id, text AS cur FROM valid WHERE text IS NOT NULL)"
    cols = []
    for (name, p) in scrub.STEPS:
        q = p.replace(r"[^\s]", r"[^ \t\n\r\f\x0b]").replace(r"[-\s]", r"[- \t\n\r\f\x0b]").replace(r"\s", r"[ \t\n\r\f\x0b]")
        with_.append(f"s_{name} AS (SELECT valid_id, {''.join(c + ', ' for c in cols)}CAST(len(regexp_extract_all(cur, '{q}')) AS INTEGER) AS {name}, regexp_replace(cur, '{q}', '\\1{packs.PLACEHOLDERS[name]}\\2', 'g') AS cur FROM {prev})")
        cols.append(name)
        prev = f"s_{name}"
    return "WITH " + ", ".join(with_) + f" SELECT valid_id, cur AS masked, {', '.join(cols)} FROM {prev}"


@query("pii_scrub_ordered", _scrub_sql())
def pii_scrub_ordered(s, d):
    t, counts = scrub.scrub(F.col("text"))
    return table(s, d, "valid", "valid_id", "text").where("text is not null").select("valid_id", t.alias("masked"), *[c.alias(k) for k, c in counts.items()])


@query("pii_counts_by_class", r"""
SELECT 'email' AS class, count(*) FILTER (regexp_matches(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}')) AS rows FROM valid
UNION ALL SELECT 'ipv4', count(*) FILTER (regexp_matches(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}')) FROM valid
UNION ALL SELECT 'rrn', count(*) FILTER (regexp_matches(text, '[0-9]{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])-[1-8][0-9]{6}')) FROM valid
UNION ALL SELECT 'business', count(*) FILTER (regexp_matches(text, '[0-9]{3}-[0-9]{2}-[0-9]{5}')) FROM valid""")
def pii_counts_by_class(s, d):
    kinds = {"email": packs.EMAIL, "ipv4": packs.IPV4, "rrn": packs.RRN, "business": packs.BUSINESS}
    one = table(s, d, "valid", "text").agg(*[F.count_if(F.col("text").rlike(p)).alias(k) for k, p in kinds.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("class"), F.col(k).alias("rows")) for k in kinds])).alias("x")).select("x.class", "x.rows")


_RRN_DIGITS = " + ".join(f"CAST(number[{i + 1 + (i >= 6)}] AS INTEGER) * {w}" for i, w in enumerate((2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5)))


@query("rrn_checksum", f"""
WITH n AS (SELECT 'valid' AS table_name, valid_id AS id, unnest(regexp_extract_all(text, '{packs.RRN}')) AS number FROM valid UNION ALL SELECT 'phase1', record_id, unnest(regexp_extract_all(text, '{packs.RRN}')) FROM phase1_data_pipeline)
SELECT table_name, id, number, (11 - ({_RRN_DIGITS}) % 11) % 10 = CAST(number[14] AS INTEGER) AS holds FROM n""")
def rrn_checksum(s, d):
    """Resident numbers in two tables with whether their check digit holds."""
    u = table(s, d, "valid", "valid_id", "text").select(F.lit("valid").alias("table_name"), F.col("valid_id").alias("id"), "text")
    u = u.unionByName(table(s, d, "phase1_data_pipeline", "record_id", "text").select(F.lit("phase1").alias("table_name"), F.col("record_id").alias("id"), "text"))
    v = u.select("table_name", "id", F.explode(F.regexp_extract_all("text", F.lit("(" + packs.RRN + ")"), F.lit(1))).alias("number"))
    return v.withColumn("holds", text.rrn_valid(F.col("number")))


@query("pii_numbers_checked", "SELECT table_name, count(*) AS numbers, count(*) FILTER (holds) AS valid_numbers FROM ({sql}) GROUP BY table_name")
def pii_numbers_checked(s, d):
    """Resident numbers found and those with a right check digit, per table."""
    return rrn_checksum(s, d).groupBy("table_name").agg(F.count("*").alias("numbers"), F.count_if("holds").alias("valid_numbers"))


Q["pii_numbers_checked"] = (pii_numbers_checked, Q["pii_numbers_checked"][1].format(sql=Q["rrn_checksum"][1]))


@query("secret_scan", r"""SELECT doc_id FROM documents WHERE regexp_matches(text, '(?:sk-[A-Za-z0-9]{16,}|hf_[A-Za-z0-9]{16,}|AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{20,}|token[ \t\n\r\f\x0b]*=[ \t\n\r\f\x0b]*\"[^\"]+\")')""")
def secret_scan(s, d):
    return docs(s, d).where(F.col("text").rlike(packs.SECRET)).select("doc_id")


# F: filters


_SPAM = "|".join(packs.SPAM)


@query("filter_reasons", f"""
WITH r AS (SELECT CASE WHEN trim(coalesce(text, '')) = '' THEN 'empty' WHEN length(trim(text)) < 5 THEN 'short' WHEN regexp_matches(text, '{_SPAM}') THEN 'spam' WHEN NOT regexp_matches(text, '[가-힣]') THEN 'no_script' END AS reason FROM documents)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS rows FROM r GROUP BY 1""".replace(r"\s", r"[ \t\n\r\f\x0b]"))
def filter_reasons(s, d):
    c = F.col("text")
    reason = filters.first_reason([("empty", F.trim(F.coalesce(c, F.lit(""))) == ""), ("short", F.length(F.trim(c)) < 5), ("spam", c.rlike(_SPAM)), ("no_script", ~c.rlike("[가-힣]"))])
    return docs(s, d).groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


@query("launch_clean_reasons", f"""
WITH r AS (SELECT CASE WHEN regexp_matches(text, '{packs.BLOCKED}') THEN 'blocked_deleted' WHEN regexp_matches(text, '{packs.CONTACT}') THEN 'contact_or_url' WHEN regexp_matches(text, '{packs.PROMO}') THEN 'promo_template' END AS reason FROM phase1_data_pipeline)
SELECT coalesce(reason, 'kept') AS reason, count(*) AS rows FROM r GROUP BY 1""")
def launch_clean_reasons(s, d):
    p = table(s, d, "phase1_data_pipeline", "text")
    return p.groupBy(F.coalesce(filters.launch_reason(F.col("text")), F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


@query("ad_matches", "SELECT record_id, regexp_extract(text, '(?i)(" + packs.AD.replace(r"\s", r"[ \t\n\r\f\x0b]") + ")', 1) AS matched FROM phase1_data_pipeline WHERE regexp_matches(text, '(?i)(" + packs.AD.replace(r"\s", r"[ \t\n\r\f\x0b]") + ")')")
def ad_matches(s, d):
    """Rows that match an advertising pattern, with what matched."""
    p = table(s, d, "phase1_data_pipeline", "record_id", "text").withColumn("matched", F.regexp_extract("text", "(?i)(" + packs.AD + ")", 1))
    return p.where("matched <> ''").select("record_id", "matched")


@query("promo_flags", f"""
SELECT record_id FROM phase1_data_pipeline WHERE regexp_matches(text, '01[016789][- .]?[0-9]{{3,4}}[- .]?[0-9]{{4}}') OR regexp_matches(text, 'https?://|open\\.kakao') OR (regexp_matches(text, '{packs.PROMO_WORDS}') AND length(text) > 60)""")
def promo_flags(s, d):
    return table(s, d, "phase1_data_pipeline", "record_id", "text").where(filters.is_promo(F.col("text"))).select("record_id")


@query("proximity_block", f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{filters.near_pattern(packs.MINOR, packs.SEXUAL)}')")
def proximity_block(s, d):
    """Texts with a term of two lists near each other, a safety rule."""
    return docs(s, d).where(filters.proximity(F.col("text"), packs.MINOR, packs.SEXUAL)).select("doc_id")


@query("proximity_terms", f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{filters.near_pattern(packs.TERMS[:6], packs.TERMS[6:12])}')")
def proximity_terms(s, d):
    """The same rule over two lists of everyday words."""
    return docs(s, d).where(filters.proximity(F.col("text"), packs.TERMS[:6], packs.TERMS[6:12])).select("doc_id")


@query("short_text_filter", "SELECT valid_id FROM valid WHERE length(text) >= 8 AND length(text) < 200 AND regexp_matches(text, '[가-힣]')")
def short_text_filter(s, d):
    c = F.col("text")
    return table(s, d, "valid", "valid_id", "text").where((F.length(c) >= 8) & (F.length(c) < 200) & c.rlike("[가-힣]")).select("valid_id")


@query("formal_ai_markers", f"SELECT row_id FROM round2_build_tc_sft WHERE regexp_matches(output, '{'|'.join(packs.FORMAL_AI)}')")
def formal_ai_markers(s, d):
    return table(s, d, "round2_build_tc_sft", "row_id", "output").where(F.col("output").rlike("|".join(packs.FORMAL_AI))).select("row_id")


@query("dup3_drop_all", f"""
WITH u AS (SELECT 'valid' AS t, valid_id AS id, text FROM valid UNION ALL SELECT 'phase1', record_id, text FROM phase1_data_pipeline),
k AS (SELECT t, id, {_WS.format(t='text')} AS c FROM u), n AS (SELECT c, count(*) AS n FROM k GROUP BY c)
SELECT t AS table_name, CAST(count(*) FILTER (n.n >= 3) AS BIGINT) AS dropped, CAST(count(*) FILTER (n.n < 3) AS BIGINT) AS kept FROM k JOIN n USING (c) GROUP BY t""")
def dup3_drop_all(s, d):
    u = table(s, d, "valid", "valid_id", "text").select(F.lit("valid").alias("table_name"), F.col("valid_id").alias("id"), "text")
    u = u.unionByName(table(s, d, "phase1_data_pipeline", "record_id", "text").select(F.lit("phase1").alias("table_name"), F.col("record_id").alias("id"), "text"))
    k = filters.frequent_copies(u, text.collapse(F.col("text")))
    return k.groupBy("table_name").agg(F.count_if(F.col("copies") >= 3).alias("dropped"), F.count_if(F.col("copies") < 3).alias("kept"))


@query("entropy_gate", """
WITH t AS (SELECT doc_id, trim(text) AS t FROM documents WHERE length(trim(text)) >= 60), g AS (SELECT doc_id, t[i:i+4] AS g FROM (SELECT doc_id, t, unnest(range(1, length(t) - 3)) AS i FROM t)),
c AS (SELECT doc_id, g, count(*) AS k FROM g GROUP BY 1, 2), n AS (SELECT doc_id, sum(k) AS n, sum(k * log2(k)) AS s FROM c GROUP BY 1)
SELECT doc_id, round(log2(n) - s / n, 6) AS entropy FROM n""")
def entropy_gate(s, d):
    return filters.entropy(docs(s, d), "doc_id", "text").select(F.col("key").alias("doc_id"), "entropy")


@query("burst_users_1h", """
WITH w AS (SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW) AS k FROM events)
SELECT user_id, count(*) AS events, max(k) AS most FROM w WHERE k >= 3 GROUP BY user_id""")
def burst_users_1h(s, d):
    b = filters.bursts(table(s, d, "events", "event_id", "user_id", "ts"), "user_id", "ts", 3)
    return b.groupBy("user_id").agg(F.count("*").alias("events"), F.max("in_window").alias("most"))


# D: deduplication


_STRIP = f"regexp_replace(text, '^{text.WS}+|{text.WS}+$', '', 'g')"


@query("dedup_exact_first", f"SELECT {_STRIP} AS text, min(doc_id) AS doc_id FROM documents WHERE length({_STRIP}) >= 5 GROUP BY 1")
def dedup_exact_first(s, d):
    t = docs(s, d).select("doc_id", text.strip(F.col("text")).alias("text")).where(F.length("text") >= 5)
    return dedup.first_wins(t, [F.col("text")], "doc_id").select("text", "doc_id")


@query("dedup_exact_pairs", "SELECT instruction, output, min(row_id) AS row_id FROM round2_build_tc_sft GROUP BY instruction, output")
def dedup_exact_pairs(s, d):
    return dedup.first_wins(table(s, d, "round2_build_tc_sft", "row_id", "instruction", "output"), [F.col("instruction"), F.col("output")], "row_id").select("instruction", "output", "row_id")


@query("dedup_composite_key", "SELECT kind, root_id, node_id, output, min(row_id) AS row_id FROM round2_build_tc_sft GROUP BY kind, root_id, node_id, output")
def dedup_composite_key(s, d):
    t = table(s, d, "round2_build_tc_sft", "row_id", "kind", "root_id", "node_id", "output")
    return dedup.first_wins(t, [F.col(c) for c in ("kind", "root_id", "node_id", "output")], "row_id").select("kind", "root_id", "node_id", "output", "row_id")


@query("dedup_canonical", f"SELECT lower({_WS.format(t='text')}) AS canon, min(valid_id) AS valid_id FROM valid GROUP BY 1")
def dedup_canonical(s, d):
    t = table(s, d, "valid", "valid_id", "text").withColumn("canon", F.lower(text.collapse(F.col("text"))))
    return dedup.first_wins(t, [F.col("canon")], "valid_id").select("canon", "valid_id")


@query("duplicate_rate", "SELECT count(*) AS rows, count(DISTINCT text) AS distinct_texts, round((count(*) - count(DISTINCT text)) / count(*), 6) AS duplicate_rate FROM phase1_data_pipeline")
def duplicate_rate(s, d):
    return dedup.duplicate_rate(table(s, d, "phase1_data_pipeline", "text"), F.col("text"))


@query("top_duplicates", "SELECT text, count(*) AS copies FROM valid GROUP BY text HAVING count(*) > 1 ORDER BY copies DESC, text LIMIT 20")
def top_duplicates(s, d):
    return table(s, d, "valid", "text").groupBy("text").agg(F.count("*").alias("copies")).where("copies > 1").orderBy(F.desc("copies"), "text").limit(20)


@query("dedup_jaccard_pairs", r"""
WITH t AS (SELECT valid_id, board, regexp_replace(text, '[ \t\n\r\f\x0b]+', '', 'g') AS t FROM valid WHERE board IS NOT NULL),
g AS (SELECT valid_id, board, list_distinct(list_transform(range(1, length(t) - 2), lambda i: t[i:i+3])) AS g FROM t WHERE length(t) >= 4)
SELECT a.valid_id AS a, b.valid_id AS b, round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 6) AS jaccard
FROM g a JOIN g b ON a.board = b.board AND a.valid_id < b.valid_id WHERE round(len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g))), 6) >= 0.85""")
def dedup_jaccard_pairs(s, d):
    v = table(s, d, "valid", "valid_id", "board", "text").where("board is not null")
    return dedup.jaccard_pairs(v, "valid_id", "board", "text")


@query("dedup_minhash_greedy", None)
def dedup_minhash_greedy(s, d):
    """Documents kept by greedy MinHash deduplication in order of doc_id."""
    return dedup.minhash_kept(docs(s, d), "doc_id", "text").where("kept").select(F.col("ord").alias("doc_id"))


@query("dedup_minhash_stats", None)
def dedup_minhash_stats(s, d):
    k = dedup.minhash_kept(docs(s, d), "doc_id", "text")
    return k.agg(F.count("*").alias("rows"), F.count_if(F.col("kept")).alias("kept")).withColumn("drop_rate", F.round(1 - F.col("kept") / F.col("rows"), 6))


@query("dedup_cosine_pairs", """
WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 20 = 0),
p AS (SELECT q.vec_id AS query, e.vec_id AS id, round(list_dot_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) / sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[]) * list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])), 6) AS cosine FROM q JOIN embeddings e ON q.vec_id <> e.vec_id)
SELECT query, id, cosine FROM p WHERE cosine >= 0.4""")
def dedup_cosine_pairs(s, d):
    return dedup.cosine_pairs(table(s, d, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", 0.4)


# J: joins and leaks


@query("leak_exact_anti", """
SELECT v.valid_id FROM valid v WHERE NOT EXISTS (SELECT 1 FROM documents t WHERE t.text = v.text) AND NOT EXISTS (SELECT 1 FROM round2_build_tc_sft r WHERE r.output = v.text)""")
def leak_exact_anti(s, d):
    """Texts are compared by a digest of 256 bits, so no text goes through a shuffle."""
    v = table(s, d, "valid", "valid_id", "text").select("valid_id", F.sha2("text", 256).alias("h"))
    a = docs(s, d).select(F.sha2("text", 256).alias("h")).where("h is not null")
    b = table(s, d, "round2_build_tc_sft", "output").select(F.sha2("output", 256).alias("h")).where("h is not null")
    return v.join(a, "h", "left_anti").join(b, "h", "left_anti").select("valid_id")


@query("leak_tagged", """
SELECT CASE WHEN v.text IN (SELECT text FROM phase1_data_pipeline WHERE text IS NOT NULL) THEN 'cpt' WHEN v.text IN (SELECT output FROM round2_build_tc_sft WHERE output IS NOT NULL) THEN 'sft' ELSE 'clean' END AS leak, count(*) AS rows FROM valid v GROUP BY 1""")
def leak_tagged(s, d):
    h = lambda c: F.sha2(c, 256).alias("h")  # noqa: E731  no text goes through a shuffle
    v = table(s, d, "valid", "text").select(h("text"))
    a = table(s, d, "phase1_data_pipeline", "text").where("text is not null").select(h("text")).distinct().withColumn("in_cpt", F.lit(True))
    b = table(s, d, "round2_build_tc_sft", "output").where("output is not null").select(h("output")).distinct().withColumn("in_sft", F.lit(True))
    tag = F.when(F.col("in_cpt"), "cpt").when(F.col("in_sft"), "sft").otherwise("clean")
    return v.join(a, "h", "left").join(b, "h", "left").groupBy(tag.alias("leak")).agg(F.count("*").alias("rows"))


@query("thread_holdout_anti", "SELECT valid_id FROM valid v WHERE source_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM round2_build_tc_sft r WHERE r.root_id = v.source_id AND r.split = 'train')")
def thread_holdout_anti(s, d):
    train = table(s, d, "round2_build_tc_sft", "root_id", "split").where("split = 'train'").select(F.col("root_id").alias("source_id"))
    return table(s, d, "valid", "valid_id", "source_id").where("source_id is not null").join(train, "source_id", "left_anti").select("valid_id")


@query("holdout_intersect", "SELECT count(*) AS shared FROM (SELECT source_id FROM valid WHERE source_id IS NOT NULL INTERSECT SELECT root_id FROM round2_build_tc_sft)")
def holdout_intersect(s, d):
    a = table(s, d, "valid", "source_id").where("source_id is not null")
    return a.intersect(table(s, d, "round2_build_tc_sft", "root_id")).agg(F.count("*").alias("shared"))


@query("thread_ids_union", "SELECT source_id AS id FROM valid WHERE source_id IS NOT NULL UNION SELECT root_id FROM round2_build_tc_sft WHERE root_id IS NOT NULL UNION SELECT source_id FROM phase1_data_pipeline WHERE source_id IS NOT NULL")
def thread_ids_union(s, d):
    u = table(s, d, "valid", "source_id").select(F.col("source_id").alias("id")).unionByName(table(s, d, "round2_build_tc_sft", "root_id").select(F.col("root_id").alias("id"))).unionByName(table(s, d, "phase1_data_pipeline", "source_id").select(F.col("source_id").alias("id")))
    return u.where("id is not null").distinct()


@query("comment_with_post", """
WITH p AS (SELECT thread_key, max_by(post_title_clean, record_id) AS title, max_by(coalesce(post_body_clean, ''), record_id) AS body FROM phase1_data_pipeline WHERE kind = 'post' GROUP BY thread_key)
SELECT c.record_id, coalesce(p.title, c.post_title_clean) AS title, coalesce(p.body, '') AS body FROM phase1_data_pipeline c LEFT JOIN p USING (thread_key) WHERE c.kind = 'comment'""")
def comment_with_post(s, d):
    t = table(s, d, "phase1_data_pipeline", "record_id", "kind", "thread_key", "post_title_clean", "post_body_clean")
    p = t.where("kind = 'post'").groupBy("thread_key").agg(F.max_by("post_title_clean", F.when(F.col("post_title_clean").isNotNull(), F.col("record_id"))).alias("title"), F.max_by(F.coalesce("post_body_clean", F.lit("")), "record_id").alias("body"))
    return t.where("kind = 'comment'").join(p, "thread_key", "left").select("record_id", F.coalesce("title", "post_title_clean").alias("title"), F.coalesce("body", F.lit("")).alias("body"))


@query("thread_parent_join", """
WITH o AS (SELECT node_id, max_by(output, row_id) AS parent_output FROM round2_build_tc_sft WHERE output IS NOT NULL GROUP BY node_id)
SELECT r.row_id, o.parent_output FROM round2_build_tc_sft r LEFT JOIN o ON o.node_id = r.parent_id""")
def thread_parent_join(s, d):
    t = table(s, d, "round2_build_tc_sft", "row_id", "node_id", "parent_id", "output")
    o = t.where("output is not null").groupBy(F.col("node_id").alias("parent_id")).agg(F.max_by("output", "row_id").alias("parent_output"))
    return t.join(o, "parent_id", "left").select("row_id", "parent_output")


@query("thread_chain", r"""
WITH k AS (SELECT DISTINCT node_id, regexp_extract(node_id, '^(.*):\[', 1) AS thread, string_split(regexp_extract(node_id, '\[([0-9-]+)\]$', 1), '-') AS seg FROM round2_build_tc_sft WHERE regexp_matches(node_id, ':\[[0-9]+(-[0-9]+)*\]$')),
p AS (SELECT node_id, i, thread || ':[' || array_to_string(seg[1:i], '-') || ']' AS anc, len(seg) AS n FROM (SELECT *, unnest(range(1, len(seg) + 1)) AS i FROM k)),
h AS (SELECT p.node_id, p.i, p.anc, p.n, k.node_id IS NOT NULL AS there FROM p LEFT JOIN k ON k.node_id = p.anc),
g AS (SELECT node_id, max(i) FILTER (NOT there) AS gap FROM h GROUP BY node_id)
SELECT h.node_id, string_agg(h.anc, '>' ORDER BY h.i) AS chain FROM h JOIN g USING (node_id) WHERE h.i > coalesce(g.gap, 0) GROUP BY h.node_id""")
def thread_chain(s, d):
    """Ancestors by key prefixes, cut at the first gap above the node: an explode and an equi-join, no recursion."""
    t = table(s, d, "round2_build_tc_sft", "node_id").distinct().where(F.col("node_id").rlike(r":\[[0-9]+(-[0-9]+)*\]$"))
    seg = F.split(F.regexp_extract("node_id", r"\[([0-9-]+)\]$", 1), "-")
    k = t.select("node_id", F.regexp_extract("node_id", r"^(.*):\[", 1).alias("thread"), seg.alias("seg"))
    p = k.select("node_id", F.explode(F.sequence(F.lit(1), F.size("seg"))).alias("i"), "thread", "seg").select("node_id", "i", F.concat("thread", F.lit(":["), F.array_join(F.slice("seg", F.lit(1), F.col("i")), "-"), F.lit("]")).alias("anc"))
    h = p.join(t.select(F.col("node_id").alias("anc"), F.lit(True).alias("there")), "anc", "left")
    g = h.groupBy("node_id").agg(F.max(F.when(F.col("there").isNull(), F.col("i"))).alias("gap"), F.array_sort(F.collect_list(F.struct("i", "anc"))).alias("all"))  # at most the depth of a key
    keep = F.filter("all", lambda x: x["i"] > F.coalesce(F.col("gap"), F.lit(0)))
    return g.select("node_id", F.array_join(F.transform(keep, lambda x: x["anc"]), ">").alias("chain"))


@query("persona_membership", """
WITH p AS (SELECT id FROM persona_list), r AS (SELECT TRY_CAST(nullif(regexp_extract(lower(trim(persona_id)), '^p?-?0*([0-9]+)$', 1), '') AS INTEGER) AS n FROM round2_build_tc_sft)
SELECT count(*) AS rows, count(*) FILTER (n IN (SELECT id FROM p)) AS matched, round(count(*) FILTER (n IN (SELECT id FROM p)) / count(*), 6) AS consistency FROM r""")
def persona_membership(s, d):
    r = table(s, d, "round2_build_tc_sft", "persona_id").select(text.persona_number(F.col("persona_id")).alias("id"))
    p = table(s, d, "persona_list", "id").distinct().withColumn("known", F.lit(1))
    m = r.join(F.broadcast(p), "id", "left").agg(F.count("*").alias("rows"), F.count("known").alias("matched"))  # the fixed persona list
    return m.withColumn("consistency", F.round(F.col("matched") / F.col("rows"), 6))


@query("source_alignment", """
SELECT r.source, count(*) AS rows, count(*) FILTER (t.text IS NOT NULL) AS matched FROM round2_build_tc_sft r LEFT JOIN (SELECT DISTINCT text FROM phase1_data_pipeline) t ON t.text = r.output WHERE r.source IS NOT NULL GROUP BY r.source""")
def source_alignment(s, d):
    r = table(s, d, "round2_build_tc_sft", "source", "output").where("source is not null").select("source", F.sha2("output", 256).alias("h"))
    t = table(s, d, "phase1_data_pipeline", "text").select(F.sha2("text", 256).alias("h")).distinct().withColumn("hit", F.lit(1))
    return r.join(t, "h", "left").groupBy("source").agg(F.count("*").alias("rows"), F.count("hit").alias("matched"))


QUERIES = Q
