"""Queries of the training-text problems: name -> (callable, SQL for the same result or None)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, table
from . import abuse, garbled, leaks, overlap, packing, pairs, pii, splits, visual

SFT, VALID = "round2_build_tc_sft", "valid"


# 1: splits that keep related records together


def _linked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, SFT, "row_id", "root_id", "author")
    b = table(spark, sf_dir, VALID, "valid_id", "source_id", "author")
    a = a.select(F.lit(SFT).alias("table_name"), F.col("row_id").alias("record_id"), F.col("root_id").alias("grp"), splits.identity(F.col("author")).alias("owner"))
    b = b.select(F.lit(VALID).alias("table_name"), F.col("valid_id").alias("record_id"), F.col("source_id").alias("grp"), splits.identity(F.col("author")).alias("owner"))
    return a.unionByName(b)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.linked_pairs(_linked_records(spark, sf_dir))


def p1_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every thread id with the number of others it must share a split with; the pairs' content without the pairs."""
    return splits.linked_members(_linked_records(spark, sf_dir)).select(F.col("grp").alias("id"), "links")


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _linked_records(spark, sf_dir).withColumn("rec", F.concat_ws(":", "table_name", F.col("record_id").cast("string")))
    out = splits.assign(r)
    name = F.substring_index("rec", ":", 1)
    return out.select(name.alias("table_name"), F.substring_index("rec", ":", -1).cast("long").alias("record_id"), "comp", "split")


P1_FOUND_SQL = f"""
WITH RECURSIVE r AS (
  SELECT root_id AS t, lower(trim(author)) AS a FROM {SFT} WHERE root_id IS NOT NULL
  UNION SELECT source_id, lower(trim(author)) FROM {VALID} WHERE source_id IS NOT NULL
), e AS (
  SELECT DISTINCT t, a FROM r WHERE a IS NOT NULL AND a NOT IN ('', 'anon', 'ㅇㅇ', '익명', '탈퇴회원')
), l AS (
  SELECT DISTINCT x.t AS s, y.t AS d FROM e x JOIN e y ON x.a = y.a WHERE x.t <> y.t
), reach(s, d) AS (
  SELECT s, d FROM l UNION SELECT reach.s, l.d FROM reach JOIN l ON l.s = reach.d
)
SELECT DISTINCT s AS id_a, d AS id_b FROM reach WHERE s < d
"""


P1_MEMBERS_SQL = f"""
WITH p AS ({P1_FOUND_SQL}), t AS (SELECT root_id AS id FROM {SFT} WHERE root_id IS NOT NULL UNION SELECT source_id FROM {VALID} WHERE source_id IS NOT NULL),
b AS (SELECT id_a AS id FROM p UNION ALL SELECT id_b FROM p)
SELECT t.id, count(b.id) AS links FROM t LEFT JOIN b ON b.id = t.id GROUP BY t.id
"""


# 2: broken pairs


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.defects(spread(table(spark, sf_dir, SFT, "row_id", "instruction", "output")), "row_id", "instruction", "output")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defects(spark, sf_dir).select(F.col("key").alias("row_id"), "defect").distinct()


def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects per kind, with their share of all rows."""
    total = table(spark, sf_dir, SFT, "row_id").agg(F.count("*").alias("all"))
    by = _defects(spark, sf_dir).groupBy("defect").agg(F.count("*").alias("rows"))
    return by.crossJoin(F.broadcast(total)).select("defect", "rows", F.round(F.col("rows") / F.col("all"), 6).alias("share"))  # one row on the right


# 3: visually identical text


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = visual.same_look(table(spark, sf_dir, VALID, "valid_id", "text"), "valid_id", "text")
    return pairs.select(F.col("a").alias("valid_a"), F.col("b").alias("valid_b"))


def p3_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, VALID, "valid_id", "text").withColumn("form", visual.unified(F.col("text")))
    return v.select("valid_id", "form", (~F.col("form").eqNullSafe(F.col("text"))).alias("changed"))


def p3_looks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with the number of spellings of its look and of rows that look the same; the pairs' content without pairs."""
    return visual.looks(table(spark, sf_dir, VALID, "valid_id", "text"), "valid_id", "text").select(F.col("key").alias("valid_id"), "spellings", "links")


def _form_sql(column: str) -> str:
    """The one form in SQL: the same tables as character lists for translate, around the engine's composition."""
    t = visual.tables()
    chars = [c for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000]
    moved = {chr(c): chr(t.first[c]) for c in chars if t.count[c] == 1 and t.first[c] != c}
    for c in chars:
        if t.count[c] > 1:
            whole = unicodedata.normalize("NFC", "".join(map(chr, t.pool[t.start[c] : t.start[c] + t.count[c]])))
            if len(whole) == 1 and whole != chr(c):
                moved[chr(c)] = whole
    gone = "".join(chr(c) for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000 and t.count[c] == 0)
    alone = {chr(c): chr(t.alone[c]) for c in range(0x1100, 0x1200) if t.alone[c] != c}
    q = lambda s: "'" + "".join(s).replace("'", "''") + "'"
    return f"translate(nfc_normalize(translate(translate({column}, {q(gone)}, ''), {q(moved)}, {q(moved.values())})), {q(alone)}, {q(alone.values())})"


P3_UNIFIED_SQL = f"SELECT valid_id, {_form_sql('text')} AS form, {_form_sql('text')} IS DISTINCT FROM text AS changed FROM {VALID}"
P3_FOUND_SQL = f"""
WITH f AS (SELECT valid_id, text, {_form_sql('text')} AS form FROM {VALID} WHERE text IS NOT NULL)
SELECT DISTINCT a.valid_id AS valid_a, b.valid_id AS valid_b FROM f a JOIN f b ON a.form = b.form AND a.text <> b.text AND a.valid_id < b.valid_id
"""
P3_LOOKS_SQL = f"""
WITH f AS (SELECT valid_id, text, {_form_sql('text')} AS form FROM {VALID} WHERE text IS NOT NULL), t AS (SELECT form, text, count(*) AS n FROM f GROUP BY 1, 2), a AS (SELECT form, count(*) AS spellings, sum(n) AS rows FROM t GROUP BY 1)
SELECT f.valid_id, a.spellings, CAST(a.rows - t.n AS BIGINT) AS links FROM f JOIN t USING (form, text) JOIN a USING (form)
"""


# 5: the same or nearly the same output in both splits


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.row_pairs(table(spark, sf_dir, SFT, "row_id", "output", "split"), "row_id", "output", "split")


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source and split: rows, rows with a partner in the other split, and the count the source reported.

    Membership is counted by class, so a text repeated in both splits is never multiplied out.
    """
    sft = table(spark, sf_dir, SFT, "row_id", "output", "split", "source")
    rows, pairs = overlap.links(sft, "row_id", "output", "split")
    hit = pairs.select(F.lit("eval").alias("split"), F.col("lcid").alias("cid")).unionByName(pairs.select(F.lit("train").alias("split"), F.col("rcid").alias("cid"))).distinct()
    hit = rows.join(hit, ["split", "cid"]).select(F.col("row").alias("row_id"), F.lit(1).alias("hit"))
    count = sft.where("source is not null and split is not null").join(hit, "row_id", "left").groupBy("source", "split").agg(F.count("*").alias("rows"), F.count("hit").alias("overlapping"))
    said = table(spark, sf_dir, "round2_sft_eval_split", "source", "train_rows", "eval_rows")
    said = said.selectExpr("source", "stack(2, 'train', train_rows, 'eval', eval_rows) as (split, reported)")
    return count.join(said, ["source", "split"], "full").select("source", "split", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("overlapping", F.lit(0)).alias("overlapping"), "reported")


# 6: abusive, hateful or sexual content


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, VALID, "valid_id", "text", "board")).withColumn("s", abuse.scored(F.col("text")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).where(F.col("s.score") >= abuse.CASE).select("valid_id").distinct()


def p6_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("valid_id", "s.score", "s.terms")


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.rates(spread(table(spark, sf_dir, VALID, "text", "board")), "text", "board").withColumnRenamed("grp", "board")


# 7: personal information


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, VALID, "valid_id", "text").select(F.lit(VALID).alias("t"), F.col("valid_id").alias("id"), "text")
    b = table(spark, sf_dir, "phase1_data_pipeline", "record_id", "post_body_clean")
    b = b.where("post_body_clean is not null").select(F.lit("phase1_data_pipeline").alias("t"), F.col("record_id").alias("id"), F.col("post_body_clean").alias("text"))
    return spread(a.unionByName(b).select(F.struct("t", "id").alias("key"), "text"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one tagger for both tables; its carriers come from valid
    fitted = pii.model(table(spark, sf_dir, VALID, "valid_id", "text"), "valid_id", "text")
    hit = pii.find(_texts(spark, sf_dir), "key", "text", fitted)
    return hit.select(F.col("key.t").alias("table_name"), F.col("key.id").alias("record_id"), "pii_type").distinct()


def p7_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = pii.model(table(spark, sf_dir, VALID, "valid_id", "text"), "valid_id", "text")
    out = pii.masked(_texts(spark, sf_dir), "key", "text", fitted)
    return out.select(F.col("key.t").alias("table_name"), F.col("key.id").alias("record_id"), "masked", "spans")


# 8: containers of fixed capacity


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", packing.token_count(F.col("text")).alias("tokens"))
    return packing.pack(docs, "doc_id", "tokens").withColumnRenamed("key", "doc_id")


# 9: evaluation passages in documents


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find(spread(table(spark, sf_dir, "documents", "doc_id", "text")), "doc_id", "text", table(spark, sf_dir, "eval_items", "item_id", "text"), "item_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).where("distance = 0").select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"))


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test items leaked as they are, and into how many documents."""
    return _leaks(spark, sf_dir).where("distance = 0").groupBy(F.col("item").alias("item_id")).agg(F.count_distinct("key").alias("documents"))


def p9_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of items with one or two edits only, none as it is."""
    return _leaks(spark, sf_dir).where("distance > 0").select(F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "distance", "run", "pieces")


P9_FOUND_SQL = """
WITH i AS (SELECT item_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '', 'g') AS t FROM eval_items WHERE text IS NOT NULL),
d AS (SELECT doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item_id, t[k:k + 39] AS w FROM (SELECT item_id, t, unnest(range(1, length(t) - 38)) AS k FROM i WHERE length(t) >= 40)),
h AS (SELECT DISTINCT doc_id, t[k:k + 39] AS w FROM (SELECT doc_id, t, unnest(range(1, length(t) - 38)) AS k FROM d WHERE length(t) >= 40))
SELECT DISTINCT h.doc_id, g.item_id FROM g JOIN h USING (w)
"""


P9_ITEMS_SQL = f"SELECT item_id, count(*) AS documents FROM ({P9_FOUND_SQL}) GROUP BY item_id"


# 10: wrong encodings


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.find(spread(table(spark, sf_dir, "documents", "doc_id", "text")), "doc_id", "text").select(F.col("key").alias("doc_id")).distinct()


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.find(spread(table(spark, sf_dir, "documents", "doc_id", "text")), "doc_id", "text").withColumnRenamed("key", "doc_id")


QUERIES = {
    "p1_found": (p1_found, P1_FOUND_SQL),
    "p1_members": (p1_members, P1_MEMBERS_SQL),
    "p1_splits": (p1_splits, None),
    "p2_found": (p2_found, None),
    "p2_rates": (p2_rates, None),
    "p3_found": (p3_found, P3_FOUND_SQL),
    "p3_looks": (p3_looks, P3_LOOKS_SQL),
    "p3_unified": (p3_unified, P3_UNIFIED_SQL),
    "p5_found": (p5_found, None),
    "p5_counts": (p5_counts, None),
    "p6_found": (p6_found, None),
    "p6_scores": (p6_scores, None),
    "p6_rates": (p6_rates, None),
    "p7_found": (p7_found, None),
    "p7_masked": (p7_masked, None),
    "p8_containers": (p8_containers, None),
    "p9_found": (p9_found, P9_FOUND_SQL),
    "p9_items": (p9_items, P9_ITEMS_SQL),
    "p9_edited": (p9_edited, None),
    "p10_found": (p10_found, None),
    "p10_restored": (p10_restored, None),
}
