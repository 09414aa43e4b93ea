"""Scalar text functions as column expressions: all stay inside generated code."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import packs

BUCKETS_A = [("xs", 20), ("sm", 50), ("md", 100), ("lg", 200), ("xl", 500)]
BUCKETS_B = [("xs", 40), ("sm", 80), ("md", 160)]
BINS = [0, 10, 20, 35, 60, 100, 160, 260, 400, 600, 900, 1400, 2200]
TAG = r"^\s*\[([0-9]+(?:-[0-9]+)*)\]\s*"
#: Unicode white space, as a class that Java's engine and RE2 read alike
WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
HASH_SPACE = "decimal(20,0)"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def falsy(*cols: Column) -> Column:
    """First column that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in cols])


def canonical(c: Column) -> Column:
    """Reply tag off, contacts masked, blanks collapsed, lower case: the key of canonical deduplication."""
    t = F.regexp_replace(c, TAG, "")
    t = F.regexp_replace(t, packs.URL, "[URL]")
    t = F.regexp_replace(t, r"01[016789][- .]?[0-9]{3,4}[- .]?[0-9]{4}", "[전화번호]")
    return F.lower(collapse(t))


def _ladder(n: Column, steps: list, last: str) -> Column:
    out = F.lit(last)
    for name, top in reversed(steps):
        out = F.when(n < top, name).otherwise(out)
    return out


def bucket_a(c: Column) -> Column:
    return _ladder(F.length(c), BUCKETS_A, "xxl")


def bucket_b(c: Column) -> Column:
    return _ladder(F.length(F.trim(c)), BUCKETS_B, "lg")


def bin14(c: Column) -> Column:
    """Histogram bin of the length: upper edges are included, the last bin takes the rest."""
    out = F.lit(len(BINS))
    for i in range(len(BINS) - 1, -1, -1):
        out = F.when(F.length(c) <= BINS[i], i).otherwise(out)
    return out


def excerpt(c: Column, most: int = 256) -> Column:
    t = F.trim(c)
    return F.when(F.length(t) > most, F.concat(F.rtrim(F.substring(t, 1, most)), F.lit("..."))).otherwise(t)


def ngrams(c: Column, n: int) -> Column:
    """All n-grams of characters, in order; none if the text is shorter."""
    return F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - (n - 1)), lambda i: F.substring(c, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def shingles(c: Column, n: int = 5) -> Column:
    t = F.lower(collapse(c))
    return F.when(F.length(t) < n, F.array(t)).otherwise(F.array_distinct(ngrams(t, n)))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def density(c: Column, pattern: str) -> Column:
    n = F.length(c)
    return F.when(n > 0, count_of(c, pattern) / n).otherwise(F.lit(0.0))


def occurrences(c: Column, term: str) -> Column:
    """Times ``term`` occurs without overlap."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(term), F.lit("")))) / F.lit(len(term))).cast("long")


def approx_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.bround(F.length(c) / F.lit(2.2)).cast("int"))


def hash64(c: Column) -> Column:
    """First 16 hex digits of SHA-256 as an unsigned number."""
    return F.conv(F.substring(F.sha2(c, 256), 1, 16), 16, 10).cast(HASH_SPACE)


def hash64_mod(c: Column, n: int) -> Column:
    return (hash64(c) % F.lit(n).cast(HASH_SPACE)).cast("int")


def md5_mod_10000(c: Column) -> Column:
    """The whole 128-bit digest modulo 10,000, from its two halves (2**64 is 1,616 modulo 10,000)."""
    h = F.md5(c)
    half = lambda a: (F.conv(F.substring(h, a, 16), 16, 10).cast(HASH_SPACE) % F.lit(10000).cast(HASH_SPACE)).cast("long")
    return ((half(1) * 1616 + half(17)) % 10000).cast("int")


def tone4(c: Column) -> Column:
    out = F.lit("일상")
    for name, pattern in reversed(packs.TONE4):
        out = F.when(c.rlike(pattern), name).otherwise(out)
    return out


def tone_votes(c: Column) -> Column:
    """존댓말 or 반말 if more than 0.7 of the line endings that tell are of it, else 혼합."""
    a, b = count_of(c, "(?m)" + packs.POLITE), count_of(c, "(?m)" + packs.CASUAL)
    return F.when((a + b) == 0, "혼합").when(a / (a + b) > 0.7, "존댓말").when(b / (a + b) > 0.7, "반말").otherwise("혼합")


def topics(c: Column) -> Column:
    hits = F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(k)) for k, p in packs.TOPICS.items()]))
    return F.when(F.size(hits) == 0, F.array(F.lit("기타"))).otherwise(hits)


def any_term(c: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(t)) for t in terms])


def distinct_terms(c: Column, terms: list[str]) -> Column:
    """Distinct terms found scanning from the left; where one begins another, list order decides."""
    return F.size(F.array_distinct(F.regexp_extract_all(c, F.lit("(" + "|".join(terms) + ")"), F.lit(1))))


def loss_weight(cells: list[Column], terms: list[str] = packs.TERMS, least: int = 2, weight: float = 1.5) -> Column:
    found = F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(" + "|".join(terms) + ")"), F.lit(1)) for c in cells])))
    return F.when(F.size(found) >= max(least, 1), F.lit(max(weight, 1.0))).otherwise(F.lit(1.0))


def ai_score(c: Column) -> Column:
    """Two for a formal ending, minus two for slang, one for a line break, minus one below 40 characters."""
    n = lambda cond, k: F.when(cond, k).otherwise(0)
    return n(F.trim(c).rlike(packs.FORMAL_END), 2) + n(c.rlike(packs.SLANG), -2) + n(F.contains(c, F.lit("\n")), 1) + n(F.length(c) < 40, -1)


def reply_parts(c: Column) -> dict[str, Column]:
    """Key, depth by segments, depth by index and body of a tagged reply; an untagged one has no key."""
    key = F.regexp_extract(c, TAG, 1)
    segments = F.when(key == "", F.lit(0)).otherwise(F.size(F.split(key, "-")))
    two = F.regexp_extract(c, r"^\s*\[([0-9]+)-([0-9]+)\]", 2)
    index = F.when(two != "", two.try_cast("int") + 1).otherwise(F.lit(1))
    return {"key": F.when(key != "", key), "segments": segments, "index": index, "body": F.regexp_replace(c, TAG, "")}


def kind_of(c: Column) -> Column:
    k = F.lower(F.trim(c))
    return F.when(k.isin("comment", "context_comment", "reply", "comments"), "comment").when(k.isin("post", "context_post", "post_title", "article"), "post")


def persona_number(c: Column) -> Column:
    """The number in ``p-001``, ``001`` or ``1``; null if there is none."""
    return F.regexp_extract(F.lower(F.trim(c)), r"^p?-?0*([0-9]+)$", 1).try_cast("int")


def date_of(c: Column) -> Column:
    """ISO dates with ``Z`` or an offset, with or without a time, as the UTC instant; null if unreadable."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(c), "Z$", "+00:00"))


def rrn_valid(c: Column) -> Column:
    """Whether the check digit of a 13-digit resident number holds."""
    d = F.transform(F.split(F.regexp_replace(c, "[^0-9]", ""), ""), lambda x: x.try_cast("int"))
    weights = F.array(*[F.lit(w) for w in (2, 3, 4, 5, 6, 7, 8, 9, 2, 3, 4, 5)])
    total = F.aggregate(F.zip_with(F.slice(d, 1, 12), weights, lambda a, b: a * b), F.lit(0), lambda s, x: s + x)
    return F.when(F.length(F.regexp_replace(c, "[^0-9]", "")) == 13, (11 - total % 11) % 10 == F.element_at(d, 13)).otherwise(F.lit(False))


def restore_jamo_map() -> tuple[str, str]:
    """Conjoining letters and the stand-alone letters they come from under compatibility composition."""
    pairs = {}
    for c in range(0x3131, 0x318F):
        n = unicodedata.normalize("NFKC", chr(c))
        if len(n) == 1 and n != chr(c):
            pairs.setdefault(n, chr(c))
    return "".join(pairs), "".join(pairs.values())


def restore_jamo(c: Column) -> Column:
    return F.translate(c, *restore_jamo_map())


def nfkc(c: Column) -> Column:
    """Compatibility composition, then stand-alone letters back (no builtin: one Arrow call per batch)."""
    table = str.maketrans(*restore_jamo_map())

    @F.arrow_udf("string")
    def run(t: pa.Array) -> pa.Array:
        return pa.array([None if s is None else unicodedata.normalize("NFKC", s).translate(table) for s in t.to_pylist()], pa.string())

    return run(c)


def term_density(c: Column, terms: list[str]) -> Column:
    """Occurrences of the terms per thousand characters; 0 for empty text."""
    n = reduce(lambda a, b: a + b, [occurrences(c, t) for t in terms])
    return F.when(F.length(c) > 0, n / F.length(c) * 1000).otherwise(F.lit(0.0))


# A comment's own tag, up to 30 characters in, and the tags of what it refers to.
OWN_TAG = r"^(?:[^\[\n]{0,30})?\[([0-9]+(?:-[0-9]+)*)\]"
REF_TAGS = r"^(?:(?:[^ \t\n\r\f]+[ \t\n\r\f]+)?\[[0-9]+(?:-[0-9]+)*\][ \t\n\r\f]*)+"


def cleaned_comment(c: Column) -> dict[str, Column]:
    """``key``: the comment's own tag, or null; ``body``: what follows it without any number of reference tags."""
    t = strip(F.replace(c, F.lit("\u00a0"), F.lit(" ")))
    key = F.regexp_extract(t, OWN_TAG, 1)
    rest = F.regexp_replace(t, OWN_TAG + r"[ \t\n\r\f]*", "")
    return {"key": F.when(key != "", key), "body": strip(F.regexp_replace(rest, REF_TAGS, ""))}


def kind_derived(kinds: list[Column], post: Column, comment: Column, prompts: list[Column], body: Column) -> Column:
    """``post`` or ``comment``: from the named kinds, else from which of the two texts is there, else from hints in the
    prompts, else from a reply tag, else a post."""
    blob = F.lower(F.concat_ws("\n", *prompts))
    has_post, has_comment = falsy(post).isNotNull(), falsy(comment).isNotNull()
    return F.coalesce(
        *[kind_of(k) for k in kinds],
        F.when(has_comment & ~has_post, "comment").when(has_post & ~has_comment, "post"),
        F.when(blob.rlike("댓글|답글|comment|reply"), "comment").when(blob.rlike("게시글|본문|post|원글"), "post"),
        F.when(body.rlike(r"^[ \t\n]*\[[0-9]+(?:-[0-9]+)*\]"), "comment").otherwise("post"),
    )


def joined(*cols: Column) -> Column:
    """The cells that are neither null nor empty, one per line."""
    return F.concat_ws("\n", *[F.when(c != "", c) for c in cols])


def label_of(c: Column, labels: tuple[str, ...] = ("AI", "HUMAN"), default: str = "HUMAN") -> Column:
    """The label a judge gave: the field ``label`` of a JSON answer, else the first label named in it, else the default."""
    given = F.upper(F.trim(F.get_json_object(F.when(F.try_parse_json(c).isNotNull(), c), "$.label")))
    named = F.upper(F.regexp_extract(c, r"(?i)\b(" + "|".join(labels) + r")\b", 1))
    return F.coalesce(F.when(given.isin(*labels), given), F.when(named != "", named), F.lit(default))


def without_formal_tail(c: Column) -> Column:
    """Lines trimmed, empty ones dropped, and the last one dropped if it ends formally, unless nothing is left."""
    lines = F.filter(F.transform(F.split(c, "\n"), strip), lambda x: x != "")
    last = F.try_element_at(lines, F.lit(-1))
    cut = F.when(last.rlike(r"(?:습니다|입니다|드립니다|하겠습니다)[ \t]*[.!?~]*$"), F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    return F.coalesce(F.nullif(F.array_join(cut, "\n"), F.lit("")), strip(c))


def overlay(base: Column, over: Column) -> Column:
    """The map ``base`` with the entries of ``over`` in place of its own; null entries of ``over`` are none."""
    given = map_given(over)
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(given), k)), given)


def map_given(c: Column) -> Column:
    return F.map_filter(F.coalesce(c, F.create_map().cast("map<string,string>")), lambda _, v: v.isNotNull())
