"""Ordered masking of personal data, with counts per class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import packs, text

# every step: class, pattern with what stays in groups 1 and 2, replacement
STEPS = [
    ("rrn", rf"(^|[^0-9]){packs.RRN}($|[^0-9])"),
    ("phone", rf"(^|[^0-9]){packs.PHONE}($|[^0-9])"),
    ("business", rf"(^|[^0-9]){packs.BUSINESS}($|[^0-9])"),
    ("account", packs.ACCOUNT + "()"),
    ("email", f"(){packs.EMAIL}()"),
    ("url", f"(){packs.URL}()"),
]


def scrub(c: Column) -> tuple[Column, dict[str, Column]]:
    """The masked text and the number of replacements of every class, in this order of steps."""
    counts: dict[str, Column] = {}
    t = c
    for name, pattern in STEPS:
        counts[name] = F.regexp_count(t, F.lit(pattern))
        t = F.regexp_replace(t, pattern, "$1" + packs.PLACEHOLDERS[name].replace("$", "") + "$2")
    return t, counts


def scrub_checked(c: Column) -> Column:
    """Only resident numbers whose check digit holds are masked; others of that shape stay."""
    numbers = F.array_distinct(F.regexp_extract_all(c, F.lit("(" + packs.RRN + ")"), F.lit(1)))
    return F.aggregate(numbers, c, lambda t, n: F.when(text.rrn_valid(n), F.replace(t, n, F.lit(packs.PLACEHOLDERS["rrn"]))).otherwise(t))
