"""Supervised and preference examples from threads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import packs, text
from . import sampling

IGNORE = -100


def token_ids(c: Column) -> Column:
    """Stand-in for a tokenizer: a stable number per white-space token, from the first 16 bits of its MD5."""
    words = F.regexp_extract_all(c, F.lit(f"([^{text.WS[1:]}+)"), F.lit(1))
    return F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int") % 32768))


def masked_example(prompt: Column, answer: Column, most: int) -> dict[str, Column]:
    """Input ids, attention mask and labels; the prompt's labels are ignored, everything is cut at ``most``."""
    ids = F.slice(F.concat(prompt, answer), 1, most)
    labels = F.slice(F.concat(F.array_repeat(F.lit(IGNORE), F.size(prompt)), answer), 1, most)
    return {"input_ids": ids, "attention_mask": F.array_repeat(F.lit(1), F.size(ids)), "labels": labels, "trainable": F.exists(labels, lambda x: x != IGNORE)}


def messages(system: Column | None, user: Column, assistant: Column) -> Column:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    turns = ([turn("system", system)] if system is not None else []) + [turn("user", user), turn("assistant", assistant)]
    return F.array(*turns)


def thread_pairs(df: DataFrame) -> DataFrame:
    """Reply rows with the text of the reply above, post title and body split from the instruction, and depth."""
    parent = df.where("output is not null").groupBy(F.col("node_id").alias("parent_id")).agg(F.max_by("output", "row_id").alias("parent_comment"))
    title = F.regexp_extract("instruction", r"^\[POST-TITLE\] ?(.*)", 1)
    body = F.regexp_extract("instruction", r"(?s)\n\[POST-BODY\] ?(.*)$", 1)
    r = text.reply_parts(F.col("output"))
    out = df.where("output is not null").join(parent, "parent_id", "left")
    return out.select("row_id", title.alias("post_title"), text.excerpt(body).alias("post_body_excerpt"), F.coalesce("parent_comment", F.lit("")).alias("parent_comment"), r["body"].alias("target_comment"), r["segments"].alias("depth"))


def placed(df: DataFrame, key: str, c: str, name: str, seed: int) -> DataFrame:
    """``(pair, name)``: the rows with their place in hash order."""
    h = F.concat_ws("|", F.sha1(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), F.lpad(F.col(key).cast("string"), 20, "0"))
    return sampling.row_numbers(df.select(F.col(c).alias(name), h.alias("h")), "h").select(F.col("rn").alias("pair"), name)


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str, c: str, seed: int = 11) -> DataFrame:
    """``(pair, chosen, rejected)``: the i-th chosen with the i-th rejected, each side in hash order.

    Places come from running counts by ranges, so no task sees a whole side.
    """

    return placed(chosen, key, c, "chosen", seed).join(placed(rejected, key, c, "rejected", seed), "pair")


def synthetic_negative(c: Column, key: Column) -> Column:
    """A formal opening, a formal closing or both around a text, by hash."""
    head, tail = F.lit(packs.FORMAL_AI[0] + " 점을 안내드립니다. "), F.lit(" " + packs.FORMAL_AI[6])
    mode = text.hash64_mod(key, 3)
    return F.when(mode == 0, F.concat(head, c)).when(mode == 1, F.concat(c, tail)).otherwise(F.concat(head, c, tail))


MARK = "<|im_start|>assistant\n"  # Fixed value: what opens an assistant's turn.


def raw_example(c: Column, most: int, end: int = 0) -> dict[str, Column]:
    """Raw rows: every id, with the end id after them, is a label; cut at ``most``."""
    ids = F.slice(F.concat(token_ids(c), F.array(F.lit(end))), 1, most)
    return {"input_ids": ids, "attention_mask": F.array_repeat(F.lit(1), F.size(ids)), "labels": ids}


def chat_text(system: str, user: Column, assistant: Column) -> Column:
    """The turns as marked text."""
    turn = lambda role, c: F.concat(F.lit(f"<|im_start|>{role}\n"), c, F.lit("<|im_end|>\n"))
    return F.concat(turn("system", F.lit(system)), turn("user", user), turn("assistant", assistant))


def chat_example(full: Column, most: int) -> dict[str, Column]:
    """Labels from the last assistant mark on; what stands before it, and the mark, is ignored. Without a mark all of it
    is learned."""
    before = F.length(full) - F.length(F.substring_index(full, MARK, -1))
    ids = F.slice(token_ids(full), 1, most)
    skip = F.least(F.when(before > 0, F.size(token_ids(F.substring(full, F.lit(1), before)))).otherwise(0), F.size(ids))
    labels = F.concat(F.array_repeat(F.lit(IGNORE), skip), F.slice(ids, skip + 1, F.greatest(F.size(ids) - skip, F.lit(0))))
    return {"input_ids": ids, "attention_mask": F.array_repeat(F.lit(1), F.size(ids)), "labels": labels, "trainable": F.exists(labels, lambda x: x != IGNORE)}


def prompt_and_answer(instruction: Column, context: Column, output: Column, post: Column, comment: Column) -> dict[str, Column]:
    """``branch``, ``prompt`` and ``answer`` of a row in one of two schemas: instruction and output where either is there,
    else post and comment. A row that lacks a part of its schema has neither."""
    s = lambda c: text.strip(F.coalesce(c, F.lit("")))
    first = instruction.isNotNull() | output.isNotNull()
    head, tail = F.when(first, s(instruction)).otherwise(s(post)), F.when(first, s(output)).otherwise(s(comment))
    whole = (head != "") & (tail != "")
    extra = F.when(first & (s(context) != ""), F.concat(F.lit("\n"), s(context))).otherwise("")
    return {"branch": F.when(first, "instruction").otherwise("post"), "prompt": F.when(whole, F.concat(head, extra, F.lit("\n"))), "answer": F.when(whole, tail)}


def mined_pairs(rows: DataFrame, key: str, c: str, held: DataFrame, good: Column, bad: Column, most: int, seed: int = 11) -> DataFrame:
    """``(pair, chosen, rejected, mined)``: rows that pass ``good`` and are not in ``held (h)``, each with a row that passes
    ``bad``; where these are fewer, synthetic negatives of the chosen rows fill up. At most ``most`` pairs, a parameter
    of the data set that is built."""
    chosen = rows.where(good).withColumn("h", F.sha2(text.strip(F.col(c)), 256)).join(held, "h", "left_anti").drop("h")
    pool = rows.where(bad)
    pairs = preference_pairs(chosen, pool, key, c, seed).withColumn("mined", F.lit(True))
    n = pool.count()
    rest = placed(chosen, key, c, "chosen", seed).where(F.col("pair") > n)
    rest = rest.select("pair", "chosen", synthetic_negative(F.col("chosen"), F.col("pair").cast("string")).alias("rejected"), F.lit(False).alias("mined"))
    return pairs.unionByName(rest).where(F.col("pair") <= most)
