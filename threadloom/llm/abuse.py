"""Abusive, hateful and sexual content.

Words are compared as strings of letters (syllables taken apart into jamo) after the text has been brought
to one visual form. A trie of the lexicon is walked together with a weighted Levenshtein automaton of each
word: look-alike and sound-alike letters cost half a letter, silent and lengthened ones less, anything else
a whole one, and short terms allow less than that. Noise between the letters of a word (digits, marks, blanks
after single syllables), bare initials, letters typed on the wrong keyboard and doubled syllables lead to
the same term. Distinct words are looked up once per worker.

The automaton starts at the beginning of a word, again after every term found and after words that lead up to
an insult when written without a blank (``INTRO``), as often as the word goes on. After any other syllable a strong
term counts as it is spelled, unless a harmless word covers part of it.

A hit adds its term's weight to the score of its surroundings: weights within ``WINDOW`` words add up. Words that
only support others (``SUPPORT``) count beside a term that is none of them; names of groups (``GROUPS``) count once,
beside words that degrade; insults count more right after words that address somebody. Words that mark mention
instead of use (reporting, quoting, naming) divide the sum, and words of address undo that. The document's score
is the highest of its windows; from 1 on it counts as a case.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .visual import unify_array

# The lexicon, as weight -> terms.
LEXICON = {
    1.2: "시발 씨발 씨팔 씹새 병신 등신 개새끼 개샊 개색기 개쉑 미친놈 미친년 또라이새끼 쌍놈 쌍년 썅 좆밥 좆까 좆같 엠창 지랄 염병 창녀 걸레년 보지년 개년 씹년 b신 ㅂ신 미친새끼 또라이 "
    "섹스 쎅스 야동 자위 떡칠 빨아줄 빨아줘 따먹 강간 딸딸이 byungsin byeongsin shibal sibal ssibal ssival gaesaekki gaesaeki michinnom michinnyeon jiral fuck fck fucking motherfucker bitch cunt whore slut asshole nigger faggot",
    1.1: "죽여버 뭉개버 패버린 뒤져라 뒤져버 뒈져 뒈질 짱깨 쪽바리 틀딱 맘충 한남충 된장녀 김치녀 급식충 홍어새끼 깜둥이 튀기새끼",
    0.8: "극혐 종특 미개해 미개한 내쫓아야 벌레같은 낯짝 아가리 ㅅㅅ 부숴줄 부숴버 찢어버 알몸 원나잇 주무르 nudes nude retard idiot moron",
    0.6: "닥쳐 꺼져 쓰레기야 쓰레기들 키웠냐 박고 야한짓 벗고찍은 만지고싶 worthless pathetic trash 취급 사냐 조심해라 벗은 쳐맞 패줄 죽인다 stupid dumb",
    0.5: "쓰레기 없어졌으면 야한 모텔 벗고 더럽다 역겹 만지고 찾아간다 찾아가서 밤길 것들 scum 달지마 파트너 엉덩이 빠구리 젖꼭지 ㅈㅈ",
    0.4: "놈들 가슴 망한다 토나온다 두고봐 장애인 외국인 난민 이교도 시골것 조선족 동남아 흑인 여자들 남자들 노인네 답없다 그만좀 아니냐 찍은 판다 구함 얼굴 싶다 싶어 쪽지 교환할 tonight wanna",
}
# Terms that are names of groups; terms that degrade one; terms that say nothing by themselves; insults
# that name a person; what must stand within two words before a term.
GROUPS = set("장애인 외국인 난민 이교도 시골것 조선족 동남아 흑인 여자들 남자들 노인네".split())
DEGRADING = set("극혐 종특 미개해 미개한 내쫓아야 벌레같은 없어졌으면 더럽다 역겹 것들 취급 놈들 망한다 토나온다 쓰레기 쓰레기야 쓰레기들 꺼져 닥쳐 답없다 scum trash worthless pathetic stupid dumb".split())
SUPPORT = set("얼굴 싶다 싶어 쪽지 교환할 찍은 판다 구함 아니냐 그만좀 모텔 파트너 달지마 두고봐 찾아간다 찾아가서 밤길 tonight wanna".split())
INSULTS = set("쓰레기야 벌레같은 idiot moron retard stupid dumb trash pathetic worthless scum".split())
NEEDS = {"취급": "사람"}
# Words that lead up to an insult in one written word; words that make the next ones an insult of somebody.
INTRO = "이런 저런 그런 이딴 저딴 완전 진짜 정말 존나 졸라 개같은 너 니 네 넌 너는 이 저 아 야 아오 에이 어휴 뭔 무슨 왜 걍 그냥 미친".split()
TOWARDS = set("you u ur you're youre you’re 너 넌 니가 너는 너도 니네 너희 당신은 넌진짜".split())
# Initials that stand for a term, taken only as a word's beginning.
INITIALS = {1.2: "ㅅㅂ ㅆㅂ ㅂㅅ ㅄ ㅁㅊㄴ ㅁㅊㄹ ㄱㅅㄲ ㄸㄹㅇㅅㄲ ㅆㄴ ㅅㄲ ㅈㅂ ㄷㅅ ㅈㄹ ㅈㄴ년 ㅈ밥 ㅆㅅㄲ ㄸㄹㅇ ㄷㅊㄹ"}
# Words that begin like a term and are none.
HARMLESS = "시발점 시발역 시발택시 씨발라 병신년 병신생 닥쳐올 닥쳐온 새끼손 새끼발 섹시 자위대 자위권 자위적 죽여주 미친듯 등신대 등신불 꺼져가 벗은발 scunthorpe 여자들이랑 쪽지로 박고정 가슴둘레 야한밤 좆나라 보지마 지랄리".split()
# Words and word joints that hold a strong term across their syllables and are harmless.
HARMLESS_INSIDE = (
    "전염병 감염병 질병신 열병신 병신고 병신청 병신체 병신속 다시발 역시발 즉시발 동시발 일시발 임시발 수시발 표시발 도시발 혹시발 필시발 상시발 시발점 시발역 시발송 시발생 시발견 시발표 시발행 시발급 시발매 시발전 시발언 시발령 시발주 시발효 시발달 시발사 시발명 시발자국 "
    "초등신 고등신 중등신 평등신 균등신 가로등신 형광등신 등신대 등신불 등신청 등신규 등신고 등신입 등신축 자위원 자위치 자위험 자위해 자위반 자위임 자위대 자위권 자위생 자위주 자위로 자위쪽 자위에 "
    "건강간 한강간 강간식 강간호 강간편 강간다 강간판 분야동 야동네 야동생 야동안 야동물 야동시 야동의 야동료 야동향 야동아리 야동쪽 야동원 개년 호색스 유창녀 "
    "떡칠판 떡칠십 떡칠천 따먹거리 따먹을거 섹스폰 에섹스 서섹스 웨섹스 미들섹스 써섹스 유니섹스 염병동 무지랄 시팔십 시발라 씨발라 병신년 병신생"
).split()
# Words of mention, and words of address.
MENTION = "신고 욕설 단어 표현 뜻이 어원 금지어 드라마 맛집 달력 동네 검진 주차구역 뉴스 인용".split()
ADDRESS = "너 네 니 야 글쓴이 너같은 니들 네놈 이놈 you your".split()

WINDOW = 6
CASE = 1.0

_CHO = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
_JUNG = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
_JONG = ["", *"ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"]
# Keys of the two-set Korean keyboard.
_KEYS = dict(zip("ㅂㅈㄷㄱㅅㅛㅕㅑㅐㅔㅁㄴㅇㄹㅎㅗㅓㅏㅣㅋㅌㅊㅍㅠㅜㅡㅃㅉㄸㄲㅆㅒㅖ", "qwertyuiopasdfghjklzxcvbnmQWERTOP"))
_ALIKE = ["ㅅㅆ", "ㅂㅃㅍ", "ㄱㄲㅋ", "ㄷㄸㅌ", "ㅈㅉㅊ", "ㅣㅟㅢ", "ㅏㅑ", "ㅓㅕ", "ㅗㅛ", "ㅜㅠ", "ㅐㅔㅒㅖ", "o0", "i1l", "a@4", "e3", "s5$"]
_CLASS = {c: i for i, g in enumerate(_ALIKE) for c in g}


def letters(word: str) -> str:
    out = []
    for ch in word:
        c = ord(ch) - 0xAC00
        if 0 <= c < 11172:
            out.append(_CHO[c // 588] + _JUNG[c % 588 // 28] + _JONG[c % 28])
        else:
            out.append(ch)
    return "".join(out)


def typed(word: str) -> str:
    """The keys that type the word, without shift."""
    return "".join(_KEYS.get(c, c) for c in letters(word)).lower()


def _sub(a: str, b: str) -> float:
    if a == b:
        return 0.0
    k = _CLASS.get(a)
    return 0.5 if k is not None and k == _CLASS.get(b) else 1.0


def _gap(c: str, before: str) -> float:
    """Cost of a letter too many (or missing) after ``before``."""
    if c == "ㅇ":
        return 0.25
    if c == before:
        return 0.25
    if c in _JUNG and before in _JUNG or c in "ㅓㅏㅣㅡ" and before == "ㅇ":
        return 0.5
    return 1.0


class Trie:
    __slots__ = ("next", "term", "most", "deep")

    def __init__(self):
        self.next: dict[str, Trie] = {}
        self.term: tuple[str, float, float] | None = None
        self.most = 0.0  # largest budget of the terms below
        self.deep = 0  # letters of the longest term below

    def add(self, key: str, term: str, weight: float, budget: float) -> None:
        node = self
        self.deep = max(self.deep, len(key))
        for c in key:
            node.most = max(node.most, budget)
            node = node.next.setdefault(c, Trie())
        node.most = max(node.most, budget)
        if node.term is None or node.term[1] < weight:
            node.term = (term, weight, budget)


def _budget(n: int) -> float:
    return 0.0 if n <= 4 else 0.75 if n <= 6 else 1.0 if n <= 9 else 1.5


@functools.cache
def lexicon() -> Trie:
    t = Trie()
    for w, terms in LEXICON.items():
        for term in terms.split():
            key = letters(term)
            latin = term.isascii()
            t.add(key, term, w, (0.0 if len(key) < 5 else 1.0 if len(key) > 6 else 0.5) if latin else _budget(len(key)))
            if not latin and w >= 1.1 and len(key) >= 5:
                t.add(typed(term), term, w, 0.0)
    for w, terms in INITIALS.items():
        for term in terms.split():
            t.add(term, term, w, 0.0)
    return t


_ALIKE_TO = {c: {x: _sub(c, x) for x in g} for g in _ALIKE for c in g}
REACH = 6  # the largest budget by the smallest cost: no path within budget strays farther from the diagonal


def match(key: str, root: Trie | None = None) -> list[tuple[str, float, int]]:
    """Terms that some beginning of ``key`` spells within their budget: ``(term, weight, letters used)``.

    The rows of the Levenshtein automaton go down the trie with its branches; a branch is left as soon as
    no cell of its row is within the largest budget.
    """
    root = root or lexicon()
    found: dict[str, tuple[float, int]] = {}
    n = min(len(key), root.deep + REACH)  # no path within budget reaches farther
    extra = [0.0, *(_gap(key[j], key[j - 1] if j else "") for j in range(n))]  # of a letter too many
    first = [0.0]
    for j in range(min(n, REACH)):
        first.append(first[-1] + extra[j + 1])
    here = set(key[:n])
    here |= {-1 - _CLASS[c] for c in here if c in _CLASS}
    stack = [(root, first, "", 0)]
    while stack:
        node, row, last, depth = stack.pop()
        low = min(row)
        if node.term:
            term, weight, budget = node.term
            if low <= budget:
                used = max(j for j, v in enumerate(row) if v == low)
                if term not in found or found[term][0] < weight:
                    found[term] = (weight, used)
        width, top = len(row), min(n, depth + 1 + REACH)
        for c, child in node.next.items():
            gap, most = _gap(c, last), child.most
            # a letter that the word has nothing like costs a whole one, or its gap, wherever it goes
            if c not in here and (c not in _CLASS or -1 - _CLASS[c] not in here) and low + min(gap, 1.0) > most:
                continue
            alike = _ALIKE_TO.get(c, {c: 0.0})
            best = row[0] + gap
            new, least = [best], best
            for j in range(1, top + 1):
                cost = row[j - 1] + alike.get(key[j - 1], 1.0)
                if j < width and row[j] + gap < cost:
                    cost = row[j] + gap
                if best + extra[j] < cost:
                    cost = best + extra[j]
                new.append(cost)
                best = cost
                if cost < least:
                    least = cost
            if least <= most:
                stack.append((child, new, c, depth + 1))
    return [(t, w, u) for t, (w, u) in found.items()]


_SPLIT = re.compile(r"[^0-9A-Za-z가-힣ㄱ-ㆎ]+")
_NOISE = re.compile(r"(?<=[^\W\d])[\d\W_]+(?=[^\W\d])|[^\w]+")
_DOUBLE = re.compile(r"([가-힣])\1+")
_HARMLESS = [letters(w) for w in HARMLESS]


_DIGITS = re.compile(r"\d+")


# a term of one syllable would be found in too many words
_INSIDE = {t: w for w, terms in LEXICON.items() if w >= 1.1 for t in terms.split() if len(t) > 1 and all("가" <= c <= "힣" for c in t)}
_INSIDE_AT = re.compile(f"(?<=[가-힣])(?=({'|'.join(sorted(_INSIDE, key=len, reverse=True))}))")
_SAFE_AT = re.compile(f"(?=({'|'.join(sorted(HARMLESS_INSIDE, key=len, reverse=True))}))")


def inside(form: str) -> list[tuple[str, float]]:
    """Strong terms after other syllables of the same word, as they are spelled, unless a harmless word has part of them."""
    found = [(m.start(), m[1]) for m in _INSIDE_AT.finditer(form)]
    safe = [(m.start(), m.start() + len(m[1])) for m in _SAFE_AT.finditer(form)] if found else []
    return [(t, _INSIDE[t]) for at, t in found if not any(a < at + len(t) and at < b for a, b in safe)]


def word_hits(word: str) -> tuple[tuple[str, float], ...]:
    """Terms in one written word, each once, with its weight. Digits are noise, whichever they are."""
    return _word_hits(_DIGITS.sub("0", word.lower()))


@functools.lru_cache(400_000)
def _word_hits(low: str) -> tuple[tuple[str, float], ...]:
    forms = {_NOISE.sub("", low), *(_NOISE.sub("", p) for p in _SPLIT.split(low) if len(p) > 1)}
    forms |= {_DOUBLE.sub(r"\1", f) for f in forms}
    out: dict[str, float] = {}
    # what marks keep apart is no word: each part is searched for itself
    for p in _SPLIT.split(low):
        f = _NOISE.sub("", p)
        for t, w in {*inside(f), *inside(_DOUBLE.sub(r"\1", f))}:
            out[t] = w
    for f in forms:
        key = letters(f)
        if not key or any(key.startswith(h) for h in _HARMLESS):
            continue
        for t, w in from_starts(key):
            out[t] = max(out.get(t, 0), w)
    strong = [(t, w) for t, w in out.items() if w >= 1.1]
    return (*_best(strong), *((t, w) for t, w in out.items() if w < 1.1))


def _best(found: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """One spelling is one hit of its kind: terms that edits turn into each other do not add up."""
    best: dict[str, tuple[str, float]] = {}
    for t, w in sorted(found, key=lambda x: (-x[1], x[0])):
        best.setdefault("strong" if w >= 1.1 else "group" if t in GROUPS else "support" if t in SUPPORT else "plain", (t, w))
    return list(best.values())


_INTRO = tuple(letters(w) for w in INTRO)


def from_starts(key: str) -> list[tuple[str, float]]:
    """Terms that the letters of a word spell from its beginning, after a term or after words of ``INTRO``."""
    todo, seen, out = [0], {0}, []
    while todo:
        at = todo.pop()
        got = match(key[at:])
        out += _best([(t, w) for t, w, _ in got])
        ends = [at + len(i) for i in _INTRO if key.startswith(i, at)]
        if got:
            ends.append(at + max(max(u for _, _, u in got), 1))
        for e in ends:
            if e < len(key) and e not in seen:
                seen.add(e)
                todo.append(e)
    return out


@functools.lru_cache(100_000)
def _spelled_out(form: str) -> tuple[tuple[str, float], ...]:
    key = letters(form)
    if any(key.startswith(h) for h in _HARMLESS):
        return ()
    return tuple((t, w) for t, w, _ in match(key) if w >= 1.1)


_MENTION = tuple(MENTION)
_ADDRESS = frozenset(ADDRESS)


def _syllable(w: str) -> bool:
    return len(w) == 1 and ("가" <= w <= "힣" or "ㄱ" <= w <= "ㆎ")


def score_text(text: str) -> tuple[float, list[str]]:
    """``(score, terms of the best window)`` of a text in unified form."""
    joined = text.split()
    hits: list[tuple[int, str, float]] = []
    for i, w in enumerate(joined):
        for t, x in word_hits(w):
            if t not in NEEDS or any(v.startswith(NEEDS[t]) for v in joined[max(0, i - 2) : i + 1]):
                hits.append((i, t, x))
    # spelled-out words: a run of single syllables and the word after it, of which the first may be an ending
    i = 0
    while i < len(joined):
        if not _syllable(joined[i]):
            i += 1
            continue
        end = i
        while end < len(joined) and _syllable(joined[end]):
            end += 1
        run = "".join(joined[i : end + 1])
        most = lexicon().deep + REACH  # syllables that may matter from any start
        for k in range(i, end):
            form = _NOISE.sub("", run[k - i : k - i + most].lower())
            for f in {form, _DOUBLE.sub(r"\1", form)} if len(form) > 1 else ():
                for t, x in _spelled_out(f):
                    if len(letters(t)) > len(letters(joined[k])):
                        hits.append((k, t, x))
        i = end
    if not hits:
        return 0.0, []
    hits.sort()
    best, terms = 0.0, []
    for first in range(len(hits)):
        i, near = hits[first][0], {}
        for k, t, x in hits[first:]:
            if k - i > WINDOW:
                break
            towards = t in INSULTS and not TOWARDS.isdisjoint(v.lower() for v in joined[max(0, k - 3) : k])
            near[t] = max(near.get(t, 0.0), x + 0.4 * towards)
        total = sum(x for t, x in near.items() if t not in GROUPS and t not in SUPPORT)
        if total:
            total += sum(x for t, x in near.items() if t in SUPPORT)
            if not DEGRADING.isdisjoint(near):
                total += max((x for t, x in near.items() if t in GROUPS), default=0.0)
        around = joined[max(0, i - 3) : i + WINDOW + 1]
        mention = any(w.startswith(_MENTION) or w.endswith("라는") for w in around)
        if mention and not any(w.lower() in _ADDRESS for w in around):
            total *= 0.5
        if total > best:
            best, terms = total, list(near)
    return best, terms


def scored(text: Column) -> Column:
    """``struct<score: double, terms: string>``. Null scores null; empty text scores 0. Whole texts are read."""

    @F.arrow_udf("struct<score: double, terms: string>")
    def run(t: pa.Array) -> pa.Array:
        got = [None if s is None else score_text(s) for s in unify_array(t).to_pylist()]
        mask = pa.array([g is None for g in got])
        return pa.StructArray.from_arrays(
            [pa.array([g and round(g[0], 6) for g in got], pa.float64()), pa.array([g and ",".join(g[1]) for g in got], pa.string())], names=["score", "terms"], mask=mask
        )

    return run(text)


def rates(df: DataFrame, text: str, group: str, case: float = CASE) -> DataFrame:
    """Per group (null is a group): rows with text, cases and their share. Empty input gives no rows."""
    s = df.select(F.col(group).alias("grp"), scored(F.col(text)).getField("score").alias("score")).where("score is not null")
    g = s.groupBy("grp").agg(F.count("*").alias("rows"), F.sum((F.col("score") >= case).cast("long")).alias("cases"))
    return g.withColumn("share", F.round(F.col("cases") / F.col("rows"), 6))
