"""Readers and writers of the corpus' file shapes. Order that carries meaning is an explicit column."""

from __future__ import annotations

import hashlib
import html
import json
from collections.abc import Callable
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POST = "id string, title string, content string, author string, date string, boardName string, crawledAt string, comments array<struct<id: string, author: string, content: string>>"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, value)`` split at line feeds only, so vertical tabs and separators inside a line stay."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, value)`` with 1-based line numbers. A file is read in splits: the lines of each split are
    counted, the counts (one row per split) are summed along the file, and each split goes on from there."""
    t = spark.read.option("lineSep", "\n").text(path)
    t = t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    n = t.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    lead = n.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lead"))
    within = Window.partitionBy("file", "block").orderBy("at")
    return t.join(lead, ["file", "block"]).select("file", (F.row_number().over(within) + F.col("lead")).alias("line"), "value")


def decoded(spark: SparkSession, path: str) -> DataFrame:
    """``(file, text)`` of whole small files: as UTF-8 without a byte-order mark, dropping bytes that are none."""

    @F.arrow_udf("string")
    def run(content: pa.Array) -> pa.Array:
        return pa.array([None if b is None else b.decode("utf-8", "ignore").removeprefix("\ufeff") for b in content.to_pylist()], pa.string())

    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), run(F.col("content")).alias("text"))


def jsonl(spark: SparkSession, path: str, schema: str, mode: str = "strict") -> DataFrame:
    """``strict`` fails on a bad line, ``tolerant`` skips it. Blank lines are no lines in either."""
    return spark.read.schema(schema).option("mode", {"strict": "FAILFAST", "tolerant": "DROPMALFORMED"}[mode]).json(path)


def jsonl_audit(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)``: parsed rows with their line, and ``(file, line, error, column)`` for lines that are no
    objects: ``row_not_object``, or ``bad_json`` with the column where reading failed. A path without files gives no
    rows and the error ``missing_file``."""
    if not _exists(spark, path):
        rows = spark.createDataFrame([], "line long").select("line", F.from_json(F.lit("{}"), schema).alias("r")).select("line", "r.*")
        return rows, spark.createDataFrame([(path, 0, "missing_file", 0)], "file string, line long, error string, column int")
    t = numbered(spark, path).where(F.trim("value") != "")
    ok = F.trim("value").startswith("{") & F.try_parse_json("value").isNotNull()
    rows = t.where(ok).select("line", F.from_json("value", schema).alias("r")).select("line", "r.*")

    @F.arrow_udf("int")
    def failed_at(value: pa.Array) -> pa.Array:  # bad lines only
        out = []
        for v in value.to_pylist():
            try:
                json.loads(v)
                out.append(0)
            except json.JSONDecodeError as e:
                out.append(e.colno)
        return pa.array(out, pa.int32())

    bad = t.where(~ok).withColumn("column", failed_at("value"))
    return rows, bad.select("file", "line", F.when(F.col("column") == 0, "row_not_object").otherwise("bad_json").alias("error"), "column")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: bool = False) -> str | None:
    """Replaces ``path`` by what ``write(folder)`` writes, or leaves it as it is if that fails.

    The new data is written beside it; then the old folder is moved aside and the new one moved to its place. With
    ``keep`` the old folder stays as ``PATH.bak-TIME``, whose name is returned; else it is removed at last.
    """
    fs, target = _fs(spark, path)
    new = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    staged, old = f"{path.rstrip('/')}.new-{stamp}", f"{path.rstrip('/')}.bak-{stamp}"
    try:
        write(staged)
        had = fs.exists(target)
        if had and not fs.rename(target, new(old)):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(new(staged), target):
            if had:
                fs.rename(new(old), target)
            raise OSError(f"cannot move the new data to {path}")
    except BaseException:
        fs.delete(new(staged), True)
        raise
    if had and not keep:
        fs.delete(new(old), True)
    return old if had and keep else None


def write_jsonl(df: DataFrame, path: str, keep: bool = False) -> str | None:
    """One object per line, nulls and non-ASCII characters as they are; replaced on success only, see ``replace``."""
    return replace(df.sparkSession, path, lambda to: df.write.option("ignoreNullFields", "false").json(to), keep)


def write_summary(df: DataFrame, path: str) -> None:
    """A table of one row as one JSON object in one file."""
    one = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).limit(1).coalesce(1)
    replace(df.sparkSession, path, lambda to: one.write.text(to))


def rebuild(spark: SparkSession, path: str, parameters: dict, build: Callable[[], DataFrame]) -> tuple[DataFrame, bool]:
    """``(table, built)``: the table at ``path``, built anew only if it was built with other parameters or never.

    The footprint of the parameters is part of what is replaced at once, so a table never stands beside another's."""
    mark = hashlib.sha256(json.dumps(parameters, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()
    have = f"{path.rstrip('/')}/footprint={mark}"
    if not _exists(spark, have):
        replace(spark, path, lambda to: build().write.parquet(f"{to}/footprint={mark}"))
        return spark.read.parquet(have), True
    return spark.read.parquet(have), False


def markdown(df: DataFrame, title: str) -> str:
    """A small table (metrics, checks) as Markdown."""
    rows = df.collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    body = [f"| {' | '.join(cell(v) for v in r)} |" for r in rows]
    return "\n".join([f"# {title}", "", f"| {' | '.join(df.columns)} |", f"|{'-|' * len(df.columns)}", *body, ""])


def html_report(df: DataFrame, title: str) -> str:
    """The same as a page; everything is escaped."""
    tags = lambda tag, vs: "".join(f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>" for v in vs)
    rows = "".join(f"<tr>{tags('td', r)}</tr>" for r in df.collect())
    return f"<!doctype html><meta charset='utf-8'><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table><tr>{tags('th', df.columns)}</tr>{rows}</table>"


def runs(spark: SparkSession, root: str, rows: str = "ai_generated.jsonl", report: str = "eval-report.json", schema: str = "text string, kind string") -> DataFrame:
    """Rows of every run folder beside its report: ``(run, <schema>, verdict, bigram_jsd)``; runs without a report have
    null there."""
    run = lambda c: F.element_at(F.split(c, "/"), -2)
    t = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(f"{root}/*/{rows}").select(run(F.col("_metadata.file_path")).alias("run"), "*")
    if not _exists(spark, f"{root}/*/{report}"):
        return t.select("*", F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("double").alias("bigram_jsd"))
    r = spark.read.text(f"{root}/*/{report}", wholetext=True).select(run(F.col("_metadata.file_path")).alias("run"), F.col("value").alias("v"))
    field = lambda p: F.get_json_object("v", p)
    r = r.select("run", F.coalesce(field("$.gate.verdict"), field("$.verdict")).alias("verdict"), F.coalesce(field("$.metrics.bigram_jsd"), field("$.bigram_jsd")).try_cast("double").alias("bigram_jsd"))
    return t.join(r, "run", "left")


def first_paragraphs(c: Column, least: int = 50, most: int = 512) -> Column:
    """The first paragraph of a text, cut at ``most`` characters; null below ``least``."""
    p = F.trim(F.element_at(F.split(c, "\n\n"), 1))
    return F.when(F.length(p) >= least, F.substring(p, 1, most))


def first_nonblank(df: DataFrame, c: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows in the order whose text is not blank: a fixture."""
    return df.where(F.trim(c) != "").orderBy(order).limit(n)


def posts(spark: SparkSession, path: str) -> DataFrame:
    """Raw posts from files that hold a list, or an object with ``posts`` or ``items``; other entries are skipped."""
    whole = decoded(spark, path).select("file", F.col("text").alias("v"))
    inner = F.coalesce(F.get_json_object("v", "$.posts"), F.get_json_object("v", "$.items"))
    entries = F.from_json(F.when(F.ltrim("v").startswith("["), F.col("v")).otherwise(inner), "array<string>")
    raw = whole.select("file", F.posexplode(entries).alias("at", "e")).where(F.ltrim("e").startswith("{"))
    out = raw.select("file", "at", F.from_json("e", POST).alias("p"))
    return out.where("p.id is not null or p.title is not null or p.content is not null").select("file", "at", "p.*")


def post_rows(p: DataFrame) -> DataFrame:
    """Posts and their comments as one row each: ``text, kind, author_key, thread_key``."""
    key = F.coalesce("id", F.sha2(F.concat_ws("|", "title", "content"), 256).substr(1, 16))
    who = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("anon"))
    head = p.select(F.concat_ws("\n", F.nullif(F.trim("title"), F.lit("")), F.nullif(F.trim("content"), F.lit(""))).alias("text"), F.lit("post").alias("kind"), who("author").alias("author_key"), key.alias("thread_key"))
    tail = p.select(key.alias("thread_key"), F.explode("comments").alias("c")).select(F.col("c.content").alias("text"), F.lit("comment").alias("kind"), who(F.col("c.author")).alias("author_key"), "thread_key")
    return head.unionByName(tail.select(head.columns)).where(F.trim("text") != "")


def manifest(spark: SparkSession, path: str, most: int = 1 << 30) -> DataFrame:
    """``(file, bytes, lines, sha256)`` of every file; ``lines`` are those not blank. The digest of a file above
    ``most`` bytes is null, as a file's content is one value; its other columns are read in splits."""
    files = spark.read.format("binaryFile").load(path)
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    n = spark.read.option("lineSep", "\n").text(path).groupBy(name(F.col("_metadata.file_path")).alias("file")).agg(F.count_if(F.trim("value") != "").alias("lines"))
    sums = files.where(F.col("length") <= most).select(name(F.col("path")).alias("file"), F.sha2("content", 256).alias("sha256"))
    return files.select(name(F.col("path")).alias("file"), F.col("length").alias("bytes")).join(n, "file", "left").join(sums, "file", "left").select("file", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"), "sha256")


def pins(spark: SparkSession, path: str) -> DataFrame:
    """``(name, sha256)`` scraped from lines of a table that hold a file name and 64 hex digits; the first wins."""
    t = numbered(spark, path).select("line", F.regexp_extract("value", r"([\w.\-]+\.(?:jsonl|json|md|csv|parquet))", 1).alias("name"), F.regexp_extract("value", r"\b([0-9a-f]{64})\b", 1).alias("sha256"))
    return t.where("name <> '' and sha256 <> ''").groupBy("name").agg(F.min_by("sha256", "line").alias("sha256"))


def env(spark: SparkSession, *paths: str) -> DataFrame:
    """``(key, value)`` of key=value files; comments and quotes are dropped, later files overlay earlier ones."""
    out = None
    for i, p in enumerate(paths):
        v = F.regexp_extract("value", r"^\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*(?:\s#.*)?$", 2)
        one = numbered(spark, p).select(F.lit(i).alias("i"), "line", F.regexp_extract("value", r"^\s*(?:export\s+)?([A-Za-z_]\w*)\s*=", 1).alias("key"), F.regexp_replace(v, "^[\"']|[\"']$", "").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out.where("key <> ''").groupBy("key").agg(F.max_by("value", F.struct("i", "line")).alias("value"))


def frontmatter(spark: SparkSession, path: str) -> DataFrame:
    """Notes with their front matter as a map, lists as ``a|b``, and the body: ``(file, meta, body)``."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    block = F.regexp_extract("value", r"(?s)\A---\n(.*?)\n---", 1)
    pairs = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^[\w\-]+:"))
    entry = lambda x: F.struct(F.trim(F.regexp_extract(x, r"^([\w\-]+):", 1)).alias("k"), _scalar(F.regexp_extract(x, r"^[\w\-]+:\s*(.*)$", 1)).alias("v"))
    return t.select("file", F.map_from_entries(F.transform(pairs, entry)).alias("meta"), F.regexp_replace("value", r"(?s)\A---\n.*?\n---\n?", "").alias("body"))


def _scalar(c: Column) -> Column:
    inner = F.regexp_extract(c, r"^\[(.*)\]$", 1)
    listed = F.array_join(F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), "^[\"']|[\"']$", "")), "|")
    return F.when(c.rlike(r"^\[.*\]$"), listed).otherwise(F.regexp_replace(F.trim(c), "^[\"']|[\"']$", ""))


def generation_log(spark: SparkSession, path: str) -> DataFrame:
    """``(persona, output)`` of blocks that a line ``===== persona=NAME`` opens and ``OUTPUT:`` continues."""
    t = spark.read.text(path, wholetext=True)
    b = t.select(F.explode(F.split("value", r"(?m)^=+ persona=")).alias("b")).where(F.contains("b", F.lit("OUTPUT:")))
    noise = F.filter(F.split(F.regexp_extract("b", r"(?s)OUTPUT:\s*(.*)$", 1), "\n"), lambda x: (F.trim(x) != "") & ~x.rlike(r"^(?:\[|WARN|INFO|=+$)"))
    return b.select(F.trim(F.regexp_extract("b", r"^([^\s=]+)", 1)).alias("persona"), F.array_join(noise, "\n").alias("output"))


def truth_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, source string, topic string, len int").option("header", True).csv(path)
