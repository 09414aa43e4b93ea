import json

import pytest
from pyspark.sql import functions as F

from threadloom.functions.udfs import register_udfs
from threadloom.sources import io


def test_jsonl_modes(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": 1, "t": "가"}\n\nnot json\n[1]\n{"id": 2, "t": null}\n', encoding="utf-8")
    rows, errors = io.jsonl_audit(spark, str(p), "id long, t string")
    assert [tuple(r) for r in rows.orderBy("line").collect()] == [(1, 1, "가"), (5, 2, None)]
    assert [tuple(r)[1:] for r in errors.orderBy("line").collect()] == [(3, "bad_json", 1), (4, "row_not_object", 0)]
    none, missing = io.jsonl_audit(spark, str(tmp_path / "none.jsonl"), "id long, t string")
    assert none.collect() == [] and [r.error for r in missing.collect()] == ["missing_file"]
    good = tmp_path / "b.jsonl"
    good.write_text('{"id": 1, "t": "x"}\n', encoding="utf-8")
    assert io.jsonl(spark, str(good), "id long, t string").collect()[0].t == "x"
    bad = tmp_path / "c.jsonl"
    bad.write_text('{"id": 1}\n{oops\n', encoding="utf-8")
    with pytest.raises(Exception):
        io.jsonl(spark, str(bad), "id long").collect()
    assert [r.id for r in io.jsonl(spark, str(bad), "id long", "tolerant").collect()] == [1]


def test_write_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "한글"), (2, None)], "id long, t string")
    io.write_jsonl(df.coalesce(1), str(tmp_path / "out"))
    assert sorted(map(tuple, io.jsonl(spark, str(tmp_path / "out"), "id long, t string").collect())) == [(1, "한글"), (2, None)]
    import hashlib

    f = tmp_path / "x.jsonl"
    f.write_bytes(b"a\n\nb\n")
    r = io.manifest(spark, str(f)).first()
    assert tuple(r) == ("x.jsonl", 5, 2, hashlib.sha256(b"a\n\nb\n").hexdigest())
    md = tmp_path / "t.md"
    md.write_text(f"| x.jsonl | {'a' * 64} |\n| x.jsonl | {'b' * 64} |\n")
    assert [tuple(r) for r in io.pins(spark, str(md)).collect()] == [("x.jsonl", "a" * 64)]


def test_posts(spark, tmp_path):
    post = {"id": "7", "title": "제목", "content": "본문", "author": "", "comments": [{"id": "1", "author": "kim", "content": "댓글"}]}
    (tmp_path / "a.json").write_text(json.dumps([post, 3]), encoding="utf-8")
    (tmp_path / "b.json").write_text("﻿" + json.dumps({"items": [{"title": "t", "content": "c"}]}), encoding="utf-8")
    rows = io.post_rows(io.posts(spark, str(tmp_path / "*.json"))).collect()
    got = {(r.text, r.kind, r.author_key) for r in rows}
    assert got == {("제목\n본문", "post", "anon"), ("댓글", "comment", "kim"), ("t\nc", "post", "anon")}


def test_env_frontmatter_and_log(spark, tmp_path):
    (tmp_path / "a.env").write_text("# c\nA=1\nexport B='two'\n")
    (tmp_path / "b.env").write_text('A="3"\n')
    got = {r.key: r.value for r in io.env(spark, str(tmp_path / "a.env"), str(tmp_path / "b.env")).collect()}
    assert got == {"A": "3", "B": "two"}
    (tmp_path / "n.md").write_text("---\ntitle: x y\ntags: [a, 'b']\nviews: 12\n---\nbody\n")
    n = io.frontmatter(spark, str(tmp_path / "n.md"))
    assert n.first().meta == {"title": "x y", "tags": "a|b", "views": "12"} and n.first().body == "body\n"
    n.createOrReplaceTempView("notes")
    assert spark.sql("SELECT meta['title'] t FROM notes WHERE CAST(meta['views'] AS INT) > 10 ORDER BY t LIMIT 5").first().t == "x y"
    (tmp_path / "g.log").write_text("noise\n===== persona=p1\nx\nOUTPUT: hello\nWARN z\nthere\n===== persona=p2\nOUTPUT: bye\n")
    assert {tuple(r) for r in io.generation_log(spark, str(tmp_path / "g.log")).collect()} == {("p1", "hello\nthere"), ("p2", "bye")}


def test_sql_functions(spark):
    register_udfs(spark)
    assert [tuple(r) for r in spark.sql("SELECT * FROM char_ngrams('abcd', 3)").collect()] == [(1, "abc"), (2, "bcd")]
    assert spark.sql("SELECT nfkc('ＡＢ') x").first().x == "AB"
    assert spark.sql("SELECT scrub_pii('mail a@b.com now') x, scrub_pii(NULL) y, size(minhash_signature('hello')) n").first() == ("mail [이메일] now", None, 128)


def test_line_numbers_over_splits(spark, tmp_path):
    p = tmp_path / "big.txt"
    p.write_text("".join(f"line {i}\x0b{'x' * (i % 90)}\n" for i in range(1, 3001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = io.numbered(spark, str(p)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 3000 and all(r.value.startswith(f"line {r.line}\x0b") for r in got)


def test_replace_keeps_the_old_data_if_writing_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_jsonl(spark.range(3), path)
    bad = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception):
        io.write_jsonl(bad, path)
    assert io.jsonl(spark, path, "id long").count() == 3
    kept = io.write_jsonl(spark.range(5), path, keep=True)
    assert io.jsonl(spark, path, "id long").count() == 5 and io.jsonl(spark, kept, "id long").count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(["t", kept.split("/")[-1]])


def test_rebuild_by_parameters(spark, tmp_path):
    calls = []
    build = lambda n: lambda: calls.append(n) or spark.range(n)
    for n in (2, 2, 3):
        t, built = io.rebuild(spark, str(tmp_path / "r"), {"n": n}, build(n))
        assert t.count() == n
    assert calls == [2, 3] and built


def test_reports_runs_csv_and_encodings(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1, None)], "metric string, n int, x string")
    assert io.markdown(df, "T") == "# T\n\n| metric | n | x |\n|-|-|-|\n| a\\|b | 1 |  |\n"
    assert "<td>&lt;b&gt;</td>" in io.html_report(spark.createDataFrame([("<b>",)], "t string"), "R & D") and "R &amp; D" in io.html_report(df, "R & D")
    io.write_summary(df, str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s")).first().value == '{"metric":"a|b","n":1,"x":null}'
    for run, report in (("cycle-1", '{"gate": {"verdict": "PASS"}, "metrics": {"bigram_jsd": 0.05}}'), ("cycle-2", None)):
        (tmp_path / "runs" / run).mkdir(parents=True)
        (tmp_path / "runs" / run / "ai_generated.jsonl").write_text('{"text": "x", "kind": "post"}\n')
        if report:
            (tmp_path / "runs" / run / "eval-report.json").write_text(report)
    got = {r.run: (r.text, r.verdict, r.bigram_jsd) for r in io.runs(spark, str(tmp_path / "runs")).collect()}
    assert got == {"cycle-1": ("x", "PASS", 0.05), "cycle-2": ("x", None, None)}
    (tmp_path / "g.csv").write_text("id,source,topic,len\n1,ai,t,9\n")
    assert [tuple(r) for r in io.truth_csv(spark, str(tmp_path / "g.csv")).collect()] == [("1", "ai", "t", 9)]
    (tmp_path / "e.txt").write_bytes(b"\xef\xbb\xbfab\xffc")
    assert io.decoded(spark, str(tmp_path / "e.txt")).first().text == "abc"
