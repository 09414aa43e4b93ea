"""Broken prompt and response pairs: empty, refusal, copy, other_language, truncated.

* Language: naive Bayes over character n-grams and scripts, trained from the sentences below, gives a
  posterior for prompt and response; a pair whose confident languages differ is ``other_language``.
* End of text: over all responses, every suffix of up to four characters is counted, and how often a mark
  that ends a sentence (or a laugh) follows it inside the text. Only places inside texts are counted, so
  responses that break off teach nothing about endings. Shorter suffixes smooth longer ones. A response that
  ends without a mark is ``truncated`` if that is less likely of a whole one: by the odds of an end there, times
  the share of responses in its script that end without a mark. Both are smoothed, so that few rows change no
  rule. Lists and open brackets have shapes of their own; fewer than three words are judged by shape only.
* Counts sit in a table of fixed size, added up over all partitions.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codepoints import explode, rows_of
from ..operators.counting import slot_counts
from .leaks import rolling
from .overlap import alike, edit_within

# Training sentences of the language model.
SENTENCES = {
    "ko": "오늘은 날씨가 좋아서 친구와 함께 공원에 갔어요. 그런데 사람이 너무 많아서 금방 집으로 돌아왔습니다. 내일은 일찍 일어나서 회사에 가야 해요. 이 물건은 어디에서 살 수 있나요? 저는 아직 잘 모르겠네요. 다음에 다시 연락할게요.",
    "en": "The weather was nice today, so I went to the park with my friends. There were too many people and we came back home early. Has anyone tried this before? She told me that they would not be there because of the rain. What do you think about it? We should have asked which one was theirs, though nobody knew. They charge for every ticket after my shift.",
    "es": "Hoy hacía buen tiempo y fui al parque con mis amigos. Había demasiada gente y volvimos a casa temprano. ¿Alguien sabe dónde se puede comprar esto? Me dijeron que no estaba abierto por la lluvia. Creo que deberíamos preguntar otra vez, pero nadie lo sabía. Según el dueño, también está cerca de la estación después del turno.",
    "fr": "Il faisait beau aujourd'hui, alors je suis allé au parc avec mes amis. Il y avait trop de monde et nous sommes rentrés tôt à la maison. Est-ce que quelqu'un sait où on peut acheter cela ? On m'a dit que c'était fermé à cause de la pluie. Je pense qu'il faudrait demander encore une fois, mais personne ne le savait. J'ai déjà attendu près de la gare.",
    "pt": "Hoje o tempo estava bom e fui ao parque com meus amigos. Havia gente demais e voltamos cedo para casa. Alguém sabe onde dá para comprar isso? Disseram que não estava aberto por causa da chuva. Acho que devíamos perguntar de novo, mas ninguém sabia. Então esperei na portaria e já não havia mais coisas no salão.",
    "de": "Heute war das Wetter schön, also bin ich mit meinen Freunden in den Park gegangen. Es waren zu viele Leute da und wir sind früh nach Hause gekommen. Weiß jemand, wo man das kaufen kann? Mir wurde gesagt, dass wegen des Regens geschlossen sei. Ich glaube, wir sollten noch einmal fragen, aber niemand wusste es.",
    "it": "Oggi il tempo era bello, quindi sono andato al parco con i miei amici. C'era troppa gente e siamo tornati a casa presto. Qualcuno sa dove si può comprare questo? Mi hanno detto che era chiuso per la pioggia. Penso che dovremmo chiedere di nuovo, ma nessuno lo sapeva. Della stazione non ho più notizie.",
    "nl": "Vandaag was het weer mooi, dus ging ik met mijn vrienden naar het park. Er waren te veel mensen en we kwamen vroeg thuis. Weet iemand waar je dit kunt kopen? Ze zeiden dat het gesloten was vanwege de regen. Ik denk dat we het nog een keer moeten vragen, maar niemand wist het.",
    "pl": "Dzisiaj była ładna pogoda, więc poszedłem do parku z przyjaciółmi. Było za dużo ludzi i wróciliśmy wcześnie do domu. Czy ktoś wie, gdzie można to kupić? Powiedziano mi, że było zamknięte z powodu deszczu. Myślę, że powinniśmy zapytać jeszcze raz, ale nikt nie wiedział.",
    "tr": "Bugün hava güzeldi, bu yüzden arkadaşlarımla parka gittim. Çok fazla insan vardı ve eve erken döndük. Bunu nereden alabileceğimi bilen var mı? Yağmur yüzünden kapalı olduğunu söylediler. Bence bir kez daha sormalıyız ama kimse bilmiyordu.",
    "vi": "Hôm nay thời tiết đẹp nên tôi đã đi công viên với bạn bè. Có quá nhiều người và chúng tôi về nhà sớm. Có ai biết mua cái này ở đâu không? Họ nói rằng nó đóng cửa vì trời mưa. Tôi nghĩ chúng ta nên hỏi lại, nhưng không ai biết.",
    "id": "Hari ini cuacanya bagus, jadi saya pergi ke taman bersama teman-teman. Terlalu banyak orang dan kami pulang lebih awal. Apakah ada yang tahu di mana bisa membeli ini? Katanya tempat itu tutup karena hujan. Saya pikir kita harus bertanya lagi, tetapi tidak ada yang tahu.",
    "ru": "Сегодня была хорошая погода, и я пошла в парк с друзьями. Было слишком много людей, и мы рано вернулись домой. Кто-нибудь знает, где это можно купить? Мне сказали, что было закрыто из-за дождя. Думаю, надо спросить ещё раз, но никто не знал.",
    "ja": "今日は天気がよかったので、友達と公園に行きました。人が多すぎて、早く家に帰りました。これはどこで買えますか。雨のために閉まっていると言われました。もう一度聞いたほうがいいと思いますが、誰も知りませんでした。先週は駅前で並びましたが、便利だと聞きました。",
    "zh": "今天天气很好，我和朋友们去了公园。人太多了，我们很早就回家了。有人知道在哪里可以买到这个吗？他们说因为下雨关门了。我觉得应该再问一次，可是没有人知道。上周我在那边排了几分钟的队，听说可以退。",
}
# How an answer is declined, by language.
REFUSALS = [
    r"(?:답변|응답|대답|말씀|안내|도와|도움|작성|제공|만들어|이어갈|이어 갈|설명|논의|생성|진행|요청|수행|공유해 드)[^.!?\n]{0,24}(?:수\s?(?:가|는|도)?\s?없|못합니다|못해요|못 합니다|않습니다|않겠|어렵습니다|어려워요|불가|힘듭니다|곤란)",
    r"(?:답변|응답|대답)\s?(?:을\s?)?(?:거부|거절|불가|사양)",
    r"(?:답|대답|답변|응답|말)\S{0,4}\s?(?:하지|드리지)\s?않(?:겠|습)",
    r"\b(?:i|we)(?:'m| am|’m| are)? ?(?:very |so )?(?:sorry|afraid)?,? ?(?:but )?(?:i |we )?(?:can(?:no|')?t|can’t|cannot|am unable|won't|will not|must decline|am not able)\b[^.!?]{0,60}\b(?:help|assist|answer|continue|write|provide|respond|discuss|comply|reply|fulfill|request|create)",
    r"\b(?:sorry|apologi[sz]e)\b[^.!?]{0,30}\b(?:cannot|can't|can’t|unable|won't)\b",
    r"\bas an ai\b|\bas a(?:n)? (?:artificial|language|ai)\b[^.!?]{0,40}\b(?:model|intelligence|assistant)",
    r"\b(?:lo siento|perd[oó]n|disculp)[^.!?]{0,40}\bno (?:puedo|podemos|es posible)|\bno puedo (?:ayudar|responder|continuar|escribir)",
    r"\b(?:d[ée]sol[ée]e?|je regrette|excuse)[^.!?]{0,50}\b(?:ne|n)[' ]?(?:peux|puis|suis|pouvons)\b|\bje ne peux pas (?:vous |r[ée]pondre|aider|continuer|[ée]crire)",
    r"\b(?:desculp\w*|sinto muito|lamento)[^.!?]{0,40}\bn[ãa]o (?:posso|consigo|podemos)|\bn[ãa]o posso (?:ajudar|responder|continuar|escrever)",
    r"\b(?:leider|tut mir leid|entschuldig)[^.!?]{0,50}\b(?:nicht|kein)",
    r"(?:申し訳|すみません|ごめん)[^。]{0,40}(?:できません|いたしかねます|お答え|出来ません)|お答え(?:は)?(?:できません|いたしかねます|できかねます)|回答(?:は)?(?:できません|を控え)",
    r"(?:抱歉|对不起|很遗憾)[^。]{0,30}(?:无法|不能|不便)|(?:我)?(?:无法|不能)(?:回答|提供|继续|协助|满足)",
    r"(?:извини|прости|к сожалению)[^.!?]{0,50}не (?:могу|можем)|не могу (?:помочь|ответить|продолжить|написать)",
]
REFUSAL = re.compile("|".join(REFUSALS), re.I)
# What begins an answer after all.
ANSWERS = re.compile(r"(?:^|[\s.!?])(?:대신|하지만|그래도|일단|우선|먼저|however|but|instead|here (?:is|are)|that said)\b|(?:^|\s)1[.)]\s", re.I)
# Words that open something, and marks and laughs that close a sentence.
OPENERS = re.compile(
    r"(?:^|\s)(?:그리고|그런데|근데|그래서|그러나|하지만|왜냐하면|다만|특히나?|아마도?|게다가|물론|결국은|제가|저는|또|또는|혹은|혹시|혹|및|즉|만약에?|예를 들어|첫째|둘째|그러니까|and|or|but|because|so|the|a|an|of|to|with|that|which|pero|porque|que|de|et|mais|parce que|e|mas|и|но|потому что)[,:]?$",
    re.I,
)
END_MARK = ".!?~…。！？～"
LAUGH = "ㅋㅎㅠㅜㅡ"
CLOSE = ")\"”’」』】》>]"
TAIL = re.compile(rf"[\s{re.escape(END_MARK)}{LAUGH}^;;🙂😀-🙏]+$")
PARTS = re.compile(r"^\s*\[POST-TITLE\] ?(.*?)(?:\n\[POST-BODY\] ?(.*))?$", re.S)
LABEL = re.compile(r"\[POST-(?:TITLE|BODY)\]")
TAG = re.compile(r"^\s*\[\d+(?:-\d+)*\]")
JAMO = re.compile("[ㄱ-ㆎ]")

SLOTS, ORDER = 1 << 21, 4
BITS = 15


def _script_of(cp: np.ndarray) -> np.ndarray:
    """0 none, 1 Latin, 2 Hangul, 3 kana, 4 Han, 5 Cyrillic, 6 other letters."""
    s = np.zeros(len(cp), np.int8)
    s[((cp | 32) >= 97) & ((cp | 32) <= 122) & (cp < 128) | ((cp >= 0xC0) & (cp < 0x250) & (cp != 0xD7) & (cp != 0xF7)) | ((cp >= 0x1E00) & (cp < 0x1F00))] = 1
    s[(cp >= 0xAC00) & (cp <= 0xD7A3) | (cp >= 0x3131) & (cp <= 0x318E) | (cp >= 0x1100) & (cp < 0x1200)] = 2
    s[(cp >= 0x3041) & (cp <= 0x30FF) & (cp != 0x30FB)] = 3
    s[(cp >= 0x3400) & (cp < 0xA000)] = 4
    s[(cp >= 0x400) & (cp < 0x530)] = 5
    s[(cp >= 0x530) & (cp < 0x1100) | (cp >= 0x370) & (cp < 0x400)] = 6
    return s


def _lower(cp: np.ndarray) -> np.ndarray:
    return np.where((cp >= 65) & (cp <= 90) | (cp >= 0xC0) & (cp <= 0xDE) | (cp >= 0x410) & (cp <= 0x42F), cp + 32, cp)


@functools.cache
def language_model() -> tuple[list[str], np.ndarray, np.ndarray]:
    """``(names, script table, n-gram table)`` of log likelihoods."""
    names = sorted(SENTENCES)
    grams = np.full((len(names), 1 << BITS), 0.05)
    script = np.full((len(names), 7), 0.5)
    for i, k in enumerate(names):
        cp = _lower(np.array([ord(c) for c in SENTENCES[k]], np.uint32))
        s = _script_of(cp)
        script[i] += np.bincount(s, minlength=7)[:7]
        for n in (1, 2, 3):
            np.add.at(grams[i], _slots(cp, n), 1)
    script[:, 0] = 1.0
    return names, np.log(script / script.sum(1, keepdims=True)), np.log(grams / grams.sum(1, keepdims=True))


def _slots(cp: np.ndarray, n: int) -> np.ndarray:
    return ((rolling(cp, n) * np.uint64(0xC2B2AE3D27D4EB4F + 2 * n)) >> np.uint64(64 - BITS)).astype(np.int64)


def languages(cp: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(language number, log odds to the next)`` per row; -1 for rows with fewer than eight letters."""
    names, script, grams = language_model()
    cp = _lower(cp)
    row, s, n = rows_of(off), _script_of(cp), len(off) - 1
    letter = s > 0
    score = np.zeros((len(names), n))
    hist = np.bincount(row * 7 + s, minlength=7 * n).reshape(n, 7).astype(float)
    hist[:, 0] = 0
    score += script @ hist.T * 2
    for width in (1, 2, 3):
        slot = _slots(cp, width)
        m = len(slot)
        ok = np.flatnonzero((row[:m] == row[width - 1 : width - 1 + m]) & letter[:m] & letter[width - 1 : width - 1 + m])
        r, q = row[ok], slot[ok]
        for i in range(len(names)):
            score[i] += np.bincount(r, grams[i, q], minlength=n)
    best = score.argmax(0)
    top = score[best, np.arange(n)]
    rest = score.copy()
    rest[best, np.arange(n)] = -np.inf
    letters = hist.sum(1)
    return np.where(letters >= 8, best, -1), top - rest.max(0)


# end of text


def _suffix_slots(cp: np.ndarray, n: int) -> np.ndarray:
    return ((rolling(cp, n) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - 21)).astype(np.int64)


_MARKS = np.array([ord(c) for c in END_MARK + LAUGH], np.uint32)


def count_endings(cp: np.ndarray, off: np.ndarray, acc: np.ndarray) -> None:
    """Adds a batch: suffixes of 1 to ORDER characters, those a mark follows, and per script the texts and the
    texts that end with a mark."""
    seen, marked, ends = acc[:SLOTS], acc[SLOTS : 2 * SLOTS], acc[2 * SLOTS :].reshape(2, 7)
    row = rows_of(off)
    size = np.diff(off)
    # a blank before a laugh belongs to it; the place after the last character is no evidence
    nxt = np.r_[cp[1:], 0].astype(np.uint32)
    nxt2 = np.r_[cp[2:], 0, 0].astype(np.uint32)
    same = np.r_[row[1:] == row[:-1], False] if len(row) else np.zeros(0, bool)
    same2 = np.r_[row[2:] == row[:-2], False, False][: len(row)] if len(row) > 1 else np.zeros(len(row), bool)
    follows = same & (np.isin(nxt, _MARKS) | (nxt == 32) & same2 & np.isin(nxt2, _MARKS[len(END_MARK) :]))
    inner = same & ~np.isin(cp, _MARKS) & (cp != 32)
    for n in range(1, ORDER + 1):
        slot = _suffix_slots(cp, n)
        m = len(slot)
        last = np.arange(m) + n - 1  # where the suffix ends
        ok = (row[:m] == row[last]) & inner[last] if m else np.zeros(0, bool)
        np.add.at(seen, slot[ok], 1)
        hit = ok & follows[last] if m else ok
        np.add.at(marked, slot[hit], 1)
    script = _script_of(cp)
    hist = np.bincount(row * 7 + script, minlength=7 * len(size)).reshape(-1, 7)
    hist[:, 0] = 0
    main = np.where(hist.sum(1) >= 15, hist.argmax(1), 0)
    final = np.where(size > 0, cp[np.maximum(off[1:] - 1, 0)] if len(cp) else 0, 0)
    np.add.at(ends[0], main, 1)
    np.add.at(ends[1], main, np.isin(final, _MARKS))


class Endings:
    PRIOR, WEIGHT = 0.95, 20  # share of texts that end with a mark, and the texts it stands for

    def __init__(self, acc: np.ndarray):
        acc = np.minimum(acc, 0xFFFFFFFF).astype(np.uint32)
        self.seen, self.marked, ends = acc[:SLOTS], acc[SLOTS : 2 * SLOTS], acc[2 * SLOTS :].reshape(2, 7).astype(float)
        self.bare = 1 - (ends[1] + self.PRIOR * self.WEIGHT) / (ends[0] + self.WEIGHT)

    def whole(self, text: str) -> float:
        """Odds of a whole text against one that breaks off, for one that ends with these characters and no mark."""
        p = self.chance(text)
        return p / (1 - p + 1e-9) * self.bare[_main_script(text)]

    def chance(self, text: str) -> float:
        """Chance of a mark after ``text``: shorter suffixes smooth longer ones, and the best of the suffixes
        of two characters, three and all counts, as an ending may be common while its word is not."""
        cp = np.array([ord(c) for c in text[-ORDER:]], np.uint32)
        p, best = 0.05, 0.0
        for n in range(1, len(cp) + 1):
            s = int(_suffix_slots(cp[-n:], n)[0])
            p = (self.marked[s] + 4 * p) / (self.seen[s] + 4)
            if n in (2, 3, len(cp)):
                best = max(best, float(p))
        return best


def _main_script(text: str) -> int:
    s = _script_of(np.array([ord(c) for c in text], np.uint32)) if text else np.zeros(0, np.int8)
    h = np.bincount(s[s > 0], minlength=7)
    return int(h.argmax()) if h.sum() >= 15 else 0


def is_truncated(text: str, endings: Endings, least: float = 0.02) -> bool:
    """``text`` without tag and outer blanks; ``least``: the odds below which it breaks off."""
    body = TAIL.sub("", text)
    if not body:
        return False
    if re.search(r"(?:^|\s)\d+[.)]$", body) or body[-1] in ",(:;[{“‘「『《<-/·、，：；（":
        return True
    opens = body.count("(") > body.count(")") or body.count('"') % 2 == 1 or body.count("“") > body.count("”") or body.count("「") > body.count("」")
    marked = len(body) < len(text.rstrip())
    if not marked and opens and re.search(r"[(\"“「][^()\"“”「」]{0,40}$", body):
        return True
    if marked:
        return False
    if body[-1] in CLOSE:
        return False
    if OPENERS.search(body):
        return True
    # lists: the last of numbered items has the form of the others; "a, b <word>" closes an enumeration
    items = re.findall(r"(?:^|\s)\d+[.)]\s*(.+?)(?=\s\d+[.)]\s|$)", body)
    if len(items) >= 2:
        return items[-1][-2:] != items[0][-2:]
    if re.search(r",\s\S$", body):
        return True
    if re.search(r"[^\s,]+\s[^\s,]+,\s[^\s,]+\s[^\s,]+\s[^\s,]+$", body):
        return False
    if len(body.split()) < 3:  # no clause whose end could be missing; see README
        return False
    return endings.whole(body) < least


_SENTENCE = re.compile(r"[.!?。！？](?=\s|$)|\n|[。！？]")


def refuses(text: str) -> bool:
    """A reply refuses if a refusal stands in its first two sentences, or with at most two sentences after it, and
    no answer follows the first one. Its length plays no part."""
    m = REFUSAL.search(text)
    if not m:
        return False
    last = max(x.end() for x in REFUSAL.finditer(text))
    placed = len(_SENTENCE.findall(text, 0, m.start())) < 2 or len(_SENTENCE.findall(text, last)) <= 3
    return placed and not ANSWERS.search(text, m.end())


_VISIBLE = functools.cache(lambda ch: ch.isalnum() or unicodedata.category(ch) in ("So", "Sk", "Sm", "Sc"))


def _bare(s: str) -> str:
    return "".join(filter(str.isalnum, JAMO.sub("", LABEL.sub("", s)).lower()))


def judge(instructions: list, outputs: list, endings: Endings, odds: float = 6.0) -> list[str | None]:
    """The defect of each pair, or None; the first that applies of empty, copy, refusal, other_language,
    truncated. A null output is empty; with a null instruction only the output itself is judged."""
    n = len(outputs)
    out: list[str | None] = [None] * n
    texts, copies = [], []
    parts = []
    for i, (ins, o) in enumerate(zip(instructions, outputs)):
        t = TAG.sub("", o or "", count=1).strip()
        texts.append(t)
        m = PARTS.match(ins or "")
        title, body = (m[1] or "", m[2] or "") if m else (ins or "", "")
        parts.append(title + "\n" + body)
        if not any(map(_VISIBLE, t)):
            out[i] = "empty"
            continue
        x = _bare(t)
        a, b = _bare(title), _bare(body)
        for ref in {a, b, a + b}:
            if len(ref) >= 4 and len(x) >= 4:
                if x == ref:
                    out[i] = "copy"
                elif len(ref) >= 10 and abs(len(x) - len(ref)) <= 0.1 * max(len(x), len(ref)):
                    copies.append((i, x, ref))
    if copies:
        sides = [explode(pa.array([c[k] for c in copies], pa.string()))[:2] for k in (1, 2)]
        copies = [c for c, yes in zip(copies, alike(*sides, 0.1)) if yes]
        for (i, _, _), yes in zip(copies, edit_within([c[1] for c in copies], [c[2] for c in copies], 0.1)):
            if yes and out[i] is None:
                out[i] = "copy"
    todo = [i for i in range(n) if out[i] is None]
    lang_in, odds_in = languages(*explode(pa.array([parts[i] for i in todo], pa.string()))[:2])
    lang_out, odds_out = languages(*explode(pa.array([texts[i] for i in todo], pa.string()))[:2])
    for k, i in enumerate(todo):
        t = texts[i]
        if refuses(t):
            out[i] = "refusal"
        elif lang_in[k] >= 0 and lang_out[k] >= 0 and lang_in[k] != lang_out[k] and odds_in[k] > odds and odds_out[k] > odds:
            out[i] = "other_language"
        elif is_truncated(t, endings):
            out[i] = "truncated"
    return out


def endings_of(df: DataFrame, output: str) -> Endings:
    """Counts the endings of all responses; what comes to the driver is one table of fixed size."""

    def add(b: pa.RecordBatch, acc: np.ndarray) -> None:
        cp, off, _ = explode(b.column(0))
        count_endings(cp, off, acc)

    return Endings(slot_counts(df.select(output).where(F.col(output).isNotNull()), 2 * SLOTS + 14, add))


def defects(df: DataFrame, key: str, instruction: str, output: str) -> DataFrame:
    """``(key, defect)`` for every defective row; rows that repeat a key are judged each. Nulls: see ``judge``;
    an empty table gives no rows; other columns are ignored."""
    shared = df.sparkSession.sparkContext.broadcast(endings_of(df, output))
    kind = dict(df.dtypes)[key]

    def run(batches):
        endings = shared.value
        for b in batches:
            found = judge(b.column(1).to_pylist(), b.column(2).to_pylist(), endings)
            at = [i for i, d in enumerate(found) if d]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array([found[i] for i in at], pa.string())], names=["key", "defect"])

    return df.select(key, instruction, output).mapInArrow(run, f"key {kind}, defect string")
