"""Queries over files: the tables are written in the corpus' file shapes into the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.udfs import register_udfs
from ..session import shared_dir, table, tidy_at_exit
from ..sources import io
from . import corpus

Q: dict = {}


def query(name: str, sql: str | None):
    def add(fn):
        Q[name] = (fn, sql)
        return fn

    return add


def _folder(s: SparkSession) -> str:
    root = f"{shared_dir(s)}/threadloom/files-{uuid.uuid4().hex}"
    tidy_at_exit(s, root)
    return root


@query("jsonl_error_audit", """
SELECT CASE WHEN valid_id % 17 = 0 THEN 'bad_json' WHEN valid_id % 17 = 1 THEN 'row_not_object' ELSE 'ok' END AS outcome, count(*) AS lines, CAST(CASE WHEN max(valid_id % 17) = 0 AND min(valid_id % 17) = 0 THEN 1 + length('{"valid_id": ') ELSE 0 END AS INTEGER) AS first_column FROM valid GROUP BY 1""")
def jsonl_error_audit(s, d):
    """Lines of which some are broken or no objects, read with an account of every line."""
    v = table(s, d, "valid", "valid_id", "text")
    m = F.col("valid_id") % 17
    line = F.when(m == 0, '{"valid_id": oops').when(m == 1, F.concat(F.lit("["), F.col("valid_id").cast("string"), F.lit("]"))).otherwise(F.to_json(F.struct("valid_id", "text")))
    root = _folder(s)
    v.select(line.alias("value")).write.text(root)
    rows, errors = io.jsonl_audit(s, root, "valid_id long, text string")
    good = rows.agg(F.lit("ok").alias("outcome"), F.count("*").alias("lines"), F.lit(0).alias("first_column"))
    return good.unionByName(errors.groupBy(F.col("error").alias("outcome")).agg(F.count("*").alias("lines"), F.min("column").alias("first_column")))


@query("jsonl_tolerant", "SELECT valid_id, text FROM valid WHERE valid_id % 17 <> 0")
def jsonl_tolerant(s, d):
    v = table(s, d, "valid", "valid_id", "text")
    root = _folder(s)
    v.select(F.when(F.col("valid_id") % 17 == 0, "{oops").otherwise(F.to_json(F.struct("valid_id", "text"))).alias("value")).write.text(root)
    return io.jsonl(s, root, "valid_id long, text string", "tolerant").where("valid_id is not null")


@query("jsonl_round_trip", "SELECT valid_id, text, kind, source_id FROM valid")
def jsonl_round_trip(s, d):
    """Written twice to one place: the second write replaces the first at once."""
    v = table(s, d, "valid", "valid_id", "text", "kind", "source_id")
    root = _folder(s)
    io.write_jsonl(v.limit(1), root)
    io.write_jsonl(v, root)
    return io.jsonl(s, root, "valid_id long, text string, kind string, source_id string")


@query("file_manifest_sha256", "SELECT CAST(octet_length(encode(string_agg(name, chr(10) ORDER BY id) || chr(10))) AS BIGINT) AS bytes, count(*) AS lines, sha256(string_agg(name, chr(10) ORDER BY id) || chr(10)) AS sha256 FROM persona_list")
def file_manifest_sha256(s, d):
    root = _folder(s)
    table(s, d, "persona_list", "id", "name").coalesce(1).sortWithinPartitions("id").select("name").write.text(root)
    return io.manifest(s, f"{root}/part-*").select("bytes", "lines", "sha256")


@query("raw_posts_flattened", """
WITH p AS (SELECT * FROM phase1_data_pipeline WHERE kind = 'post' AND trim(coalesce(text, '')) <> '')
SELECT 'post' AS kind, count(*) AS rows, count(*) FILTER (coalesce(nullif(trim(author_key), ''), 'anon') = 'anon') AS anonymous, CAST(sum(length(text)) AS BIGINT) AS chars FROM p
UNION ALL SELECT 'comment', count(*), count(*) FILTER (coalesce(nullif(trim(author_key), ''), 'anon') = 'anon'), CAST(sum(length(text)) AS BIGINT) FROM phase1_data_pipeline WHERE kind <> 'post' AND trim(coalesce(text, '')) <> ''""")
def raw_posts_flattened(s, d):
    """Posts and comments nested in files that hold a list or an object of lists, flattened again."""
    t = table(s, d, "phase1_data_pipeline", "record_id", "kind", "text", "author_key").where(F.trim(F.coalesce("text", F.lit(""))) != "")
    none = F.lit(None).cast("string")
    blank = F.array().cast("array<struct<id: string, author: string, content: string>>")
    posts = t.where("kind = 'post'").select(F.col("record_id").cast("string").alias("id"), none.alias("title"), F.col("text").alias("content"), F.col("author_key").alias("author"), blank.alias("comments"))
    # comments hang on a post of their own that has neither title nor content
    c = F.array(F.struct(F.col("record_id").cast("string").alias("id"), F.col("author_key").alias("author"), F.col("text").alias("content")))
    nested = t.where("kind <> 'post'").select(F.concat(F.lit("c"), F.col("record_id").cast("string")).alias("id"), none.alias("title"), none.alias("content"), none.alias("author"), c.alias("comments"))
    every = posts.unionByName(nested)
    files = max(2, -(-every.count() // 1000))  # of about a thousand posts each
    every = every.withColumn("file", F.pmod(F.xxhash64("id"), F.lit(files)))
    lists = every.groupBy("file").agg(F.to_json(F.collect_list(F.struct("id", "title", "content", "author", "comments"))).alias("j"))
    root = _folder(s)
    _write_each(lists.select("file", F.when(F.col("file") % 2 == 0, F.col("j")).otherwise(F.concat(F.lit('{"items": '), "j", F.lit("}"))).alias("j")), root)
    rows = io.post_rows(io.posts(s, f"{root}/*"))
    return rows.groupBy("kind").agg(F.count("*").alias("rows"), F.count_if(F.col("author_key") == "anon").alias("anonymous"), F.sum(F.length("text")).cast("long").alias("chars"))


@query("notes_top_viewed", "SELECT valid_id AS id, board, CAST(length(text) AS INTEGER) AS views FROM valid WHERE board IS NOT NULL AND length(text) > 60 ORDER BY views DESC, id LIMIT 20")
def notes_top_viewed(s, d):
    """``TABLE ... WHERE views > 60 SORT views DESC LIMIT 20`` over notes with front matter (a report of 20)."""
    _notes(s, d)
    return s.sql("SELECT CAST(meta['id'] AS BIGINT) AS id, meta['board'] AS board, CAST(meta['views'] AS INT) AS views FROM notes WHERE meta['board'] <> '' AND CAST(meta['views'] AS INT) > 60 ORDER BY views DESC, id LIMIT 20")


@query("notes_by_board", "SELECT board, count(*) AS notes, bool_or(length(text) > 60) AS viral FROM valid WHERE board IS NOT NULL GROUP BY board")
def notes_by_board(s, d):
    _notes(s, d)
    return s.sql("SELECT meta['board'] AS board, count(*) AS notes, bool_or(array_contains(split(meta['tags'], '[|]'), 'viral')) AS viral FROM notes WHERE meta['board'] <> '' GROUP BY 1")


def _notes(s, d) -> None:
    v = table(s, d, "valid", "valid_id", "board", "text")
    tags = F.when(F.length("text") > 60, "[note, 'viral']").otherwise("[note]")
    body = F.concat_ws("\n", F.lit("---"), F.concat(F.lit("id: "), F.col("valid_id").cast("string")), F.concat(F.lit("board: "), F.coalesce("board", F.lit(""))), F.concat(F.lit("views: "), F.length("text").cast("string")), F.concat(F.lit("tags: "), tags), F.lit("---"), F.lit("body"))
    root = _folder(s)
    _write_each(v.select(F.col("valid_id").alias("file"), body.alias("j")), root)
    io.frontmatter(s, f"{root}/*").createOrReplaceTempView("notes")


def _write_each(df: DataFrame, root: str) -> None:
    """Every value as a file of its own."""
    df.select(F.col("j").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(root)


@query("first_paragraphs", "SELECT doc_id, trim(string_split(text, chr(10) || chr(10))[1])[1:512] AS paragraph FROM documents WHERE length(trim(string_split(text, chr(10) || chr(10))[1])) >= 50")
def first_paragraphs(s, d):
    return corpus.docs(s, d).select("doc_id", io.first_paragraphs(F.col("text")).alias("paragraph")).where("paragraph is not null")


@query("identity_fixture", "SELECT valid_id, text FROM valid WHERE trim(text) <> '' ORDER BY valid_id LIMIT 64")
def identity_fixture(s, d):
    return io.first_nonblank(table(s, d, "valid", "valid_id", "text"), "text", "valid_id", 64)


@query("sql_functions", """SELECT count(*) AS grams, count(DISTINCT gram) AS distinct_grams FROM (SELECT unnest(list_transform(range(1, length(name) - 1), lambda i: name[i:i+2])) AS gram FROM persona_list WHERE length(name) >= 3)""")
def sql_functions(s, d):
    """The registered functions from SQL: trigrams of the persona names by the table function."""
    register_udfs(s)
    table(s, d, "persona_list", "name").createOrReplaceTempView("personas")
    return s.sql("SELECT count(*) AS grams, count(DISTINCT gram) AS distinct_grams FROM personas, LATERAL char_ngrams(name, 3)")


@query("sql_scrubbed", corpus.QUERIES["pii_scrub_ordered"][1].replace(" AS masked, rrn, phone, business, account, email, url", " AS masked"))
def sql_scrubbed(s, d):
    register_udfs(s)
    table(s, d, "valid", "valid_id", "text").createOrReplaceTempView("texts")
    return s.sql("SELECT valid_id, scrub_pii(text) AS masked FROM texts WHERE text IS NOT NULL")


QUERIES = Q
