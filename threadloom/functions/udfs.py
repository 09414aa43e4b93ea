"""Functions for SQL users."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import dedup
from ..session import ship
from . import packs, scrub


@F.udtf(returnType="pos int, gram string")
class CharNgrams:
    """``SELECT * FROM char_ngrams('text', 3)``: every n-gram with its 1-based place; nulls give no rows."""

    def eval(self, text: str, n: int):
        if text is not None and n:
            for i in range(len(text) - n + 1):
                yield i + 1, text[i : i + n]


def register_udfs(spark: SparkSession) -> None:
    """``nfkc(text)``, ``minhash_signature(text)``, ``scrub_pii(text)`` and the table function ``char_ngrams(text, n)``."""
    ship(spark)

    @F.arrow_udf("string")
    def nfkc(t: pa.Array) -> pa.Array:
        return pa.array([None if s is None else unicodedata.normalize("NFKC", s) for s in t.to_pylist()], pa.string())

    @F.arrow_udf("array<long>")
    def minhash_signature(t: pa.Array) -> pa.Array:
        return dedup.signatures(t)

    steps = [(re.compile(p), packs.PLACEHOLDERS[k]) for k, p in scrub.STEPS]

    @F.arrow_udf("string")
    def scrub_pii(t: pa.Array) -> pa.Array:
        out = []
        for s in t.to_pylist():
            for pattern, mark in steps if s else ():
                s = pattern.sub(lambda m, mark=mark: m[1] + mark + m[2], s)
            out.append(s)
        return pa.array(out, pa.string())

    spark.udf.register("nfkc", nfkc)
    spark.udf.register("minhash_signature", minhash_signature)
    spark.udf.register("scrub_pii", scrub_pii)
    spark.udtf.register("char_ngrams", CharNgrams)
