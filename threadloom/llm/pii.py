"""Personal information in free text: found by a character tagger, replaced by typed placeholders.

The tagger (``tagger``) is trained here, from sentences whose spans are known because they were put there:
email addresses, phone, identity, passport and licence numbers, street addresses and names in many written
forms, and look-alikes that are none (order, parcel and business numbers, dates, versions, masked numbers,
placeholders, family names with a title, nicknames, places without a number), between carrier sentences. The
carriers are built from a word list and, if given, from a bounded sample of rows (``sample``).

A text is read in its one visual form (full-width digits, composed syllables), with the place of origin of
every character, so placeholders land in the otherwise unchanged original. Every decoded span must pass a
check of its shape (digits, family name, number of a road) before it counts.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codepoints import explode
from . import tagger
from .visual import unify

TYPES = ["email", "phone", "id_number", "address", "name"]
K = 1 + 2 * len(TYPES)  # outside, and begin and inside of every type
PLACEHOLDER = {t: f"[{t.upper()}]" for t in TYPES}

# Family names.
FAMILY = "김이박최정강조윤장임한오서신권황안송류유홍전고문양손배백허남심노하곽성차주우구민나진지엄채원천방공현함변염여추도소석선설마길연위표명기반왕금옥육인맹제모탁국어은편용"
FAMILY_TWO = ["남궁", "황보", "제갈", "선우", "사공", "독고"]
# Syllables of given names, and words to build carriers, roads and places from.
GIVEN = "가람해든채움다올이든도담하늬아라솔은별누리새결소을라온한결봄결슬찬보늬미르나봄지우민준서연하은예린수현영희철수유진성호재민동현지훈승우태양보라나래초롱빛나슬기고은샛별"
ROADS = ["느티나무", "달무리", "은하수", "새벽별", "소금빛", "잔물결", "가온", "한들", "벚꽃", "청솔", "중앙", "해안", "샘터", "돌담", "무지개", "강변", "역전", "시청"]
CITIES = ["가온", "누리", "다솜", "미르", "해든", "한밭", "나래", "소라", "별하"]
DISTRICTS = ["한빛", "별내", "솔샘", "달빛", "중앙", "남산", "새들", "온누리"]
# Towns, districts and roads that exist, so that the tagger does not know invented ones only.
TOWNS = ["서울", "부산", "대구", "인천", "광주", "대전", "울산", "세종", "수원", "성남", "고양", "용인", "청주", "전주", "천안", "창원", "제주", "포항"]
WARDS = ["강남", "서초", "마포", "송파", "유성", "해운대", "수영", "달서", "분당", "영통", "덕진", "동", "서", "남", "북", "중"]
STREETS = ["테헤란", "양화", "대학", "센텀중앙", "동부", "서부", "한강", "충장", "상무", "월드컵", "올림픽", "세종", "퇴계", "불정", "효원"]
TITLES = ["실장님", "사장님", "과장님", "대표님", "원장님", "선생님", "팀장님", "부장님", "기사님", "매니저"]
NICK = ["별빛토끼", "감자도리", "하늘고래", "밤톨이", "초코우유", "달콤라떼", "파란나비"]
LATIN = ["mina", "selka", "jorin", "ilya", "yuna", "dorian", "maram", "tessa", "ravi", "otto", "lena", "karo", "hollowell", "norin", "vask", "thornby", "starkov", "pelt", "oakhollow", "marsh", "delun", "brask", "fenwick", "sorel"]
WORDS = "오늘 어제 주말에 근데 진짜 제가 친구가 사장님이 거기 여기서 커피를 책을 신발을 마셨어요 샀네요 갔다가 왔더라고요 정도면 가능하다고 말했고 부탁했지요 참고로 100분 기다려서 30번 453시간 22만원 5층 8호점 괜찮네요 좋아요 그냥 다시 미리 천천히 근처 쪽이 편하대요 은하수 달무리길에서 새솔동 느티골목 버스로 전철로 길이 막혀서 the park was nice today and they told me later la estación está cerca".split()


def _d(r, n: int) -> str:
    return "".join(map(str, r.integers(0, 10, n)))


def _pick(r, seq):
    return seq[int(r.integers(0, len(seq)))]


def _email(r) -> str:
    part = lambda a, b: "".join(_pick(r, "abcdefghijklmnopqrstuvwxyz") for _ in range(int(r.integers(a, b))))
    local = _pick(r, LATIN + [part(2, 9), part(3, 8)]) + _pick(r, ["", "", ".", "-", "_"]) + _pick(r, ["", part(1, 5), _d(r, 2), _d(r, 4), _d(r, 6)])
    local = local.rstrip(".-_") + _pick(r, ["", _d(r, 2)])
    style = min(int(r.integers(0, 11)), 8)
    at = ["@", "@", "@", "@", "[at]", "(at)", "골뱅이", "(골뱅이)", " at "][style]
    dot = "." if style < 4 else _pick(r, {4: ["[dot]", "."], 5: ["(dot)", "."], 6: ["쩜", "점", "."], 7: [".", "쩜"], 8: [" dot ", " dot ", "."]}[style])
    dom = dot.join([_pick(r, ["example", "board", "night", "mail", "kr", "corp", "post", part(3, 8)]), *([_pick(r, ["example", "test", part(3, 7)])] if r.random() < 0.4 else []), _pick(r, ["com", "net", "org", "test", "invalid", "example", "kr", "io"])])
    s = local + at + dom
    return s.upper() if r.random() < 0.15 else s


HANGUL_DIGITS = "공일이삼사오육칠팔구"


def _phone(r) -> str:
    if r.random() < 0.1:
        sep = _pick(r, ["-", "-", " ", ""])
        return sep.join(["공일공", *("".join(HANGUL_DIGITS[int(c)] for c in _d(r, 4)) for _ in range(2))])
    sep = _pick(r, ["-", "-", "-", ".", " ", " - ", ""])
    head = _pick(r, ["010", "010", "010", "011", "070", "02", "031", "O1O", "o1o", "공1공", "공일공", "0 1 0", "(010)", "010)", "(02)"])
    if head.endswith(")"):
        return head + _pick(r, ["", " "]) + _d(r, 4) + _pick(r, ["-", " ", ""]) + _d(r, 4)
    mid = 3 if head.startswith("0") and head not in ("010", "070") and r.random() < 0.5 else 4
    if r.random() < 0.2:
        return _pick(r, ["+82 10", "+82-10", "+82)10", "82-10"]) + (sep or "-") + _d(r, 4) + (sep or "-") + _d(r, 4)
    if r.random() < 0.1:
        return f"+{_pick(r, ['1', '44', '81'])} ({_d(r, 3)}) {_d(r, 3)}-{_d(r, 4)}"
    if head[0] in "Oo공" and not sep:
        sep = _pick(r, ["-", " "])
    return head + sep + _d(r, mid) + sep + _d(r, 4)


def _rrn(r) -> str:
    return f"{int(r.integers(40, 100)) % 100:02d}{int(r.integers(1, 13)):02d}{int(r.integers(1, 32)):02d}" + _pick(r, ["-", "-", "―", " - ", " ", "", "–"]) + str(int(r.integers(1, 9))) + _d(r, 6)


def _id(r) -> str:
    k = r.random()
    if k < 0.55:
        return _rrn(r)
    if k < 0.78:
        return _pick(r, "MMMSRGDOPT") + _d(r, 8)
    return f"{_d(r, 2)}-{_d(r, 2)}-{_d(r, 6)}-{_d(r, 2)}"


def _existing(r) -> tuple[str, str]:
    """Town and district, and a road."""
    town = _pick(r, TOWNS) + _pick(r, ["", "", "시"])
    return f"{town} {_pick(r, WARDS)}구", _pick(r, STREETS) + _pick(r, ["로", "길", "대로"])


def _address(r) -> str:
    if r.random() < 0.25:
        place, road = _existing(r)
        n = str(int(r.integers(1, 300))) + _pick(r, ["", "", f"-{_d(r, 1)}", f"번길 {_d(r, 2)}"])
        return f"{place} {road}{_pick(r, [' ', ' ', ''])}{n}{_pick(r, ['', '', f' {_d(r, 1)}층', f' {_d(r, 3)}호'])}"
    road = _pick(r, ROADS) + _pick(r, ["로", "길"])
    city, dist = _pick(r, CITIES) + _pick(r, ["시", "시", "군"]), _pick(r, DISTRICTS) + "구"
    n = str(int(r.integers(1, 300)))
    k = int(r.integers(0, 8))
    if k == 0:
        return f"{city} {dist} {road}{_pick(r, ['', ' '])}{n}({_pick(r, ['별빛빌라', '한들아파트', '청솔맨션'])} {_d(r, 3)}호)"
    if k == 1:
        return f"{_pick(r, ['', city + ' '])}{road} {n} {_d(r, 3)}동 {_d(r, 3)}호"
    if k == 2:
        return f"{city} {_pick(r, ['새솔', '솔샘', '한들', '돌담'])}동 {n}-{_d(r, 1)}{_pick(r, ['번지', '번지', ''])}"
    if k == 3:
        return f"{_pick(r, ['', city + ' '])}{dist} {road} {n}번길 {_d(r, 2)}{_pick(r, ['', ' ' + _d(r, 1) + '층'])}"
    if k == 4:
        a, b, c = (_pick(r, ["Moonlit", "Hanbit", "Gaon", "Byeolnae", "Saebyeok", "Narae", "Mireu"]) for _ in range(3))
        return f"{n} {a}-{_pick(r, ['ro', 'gil', 'daero'])}, {b}-gu, {c}-si"
    if k == 5:
        return f"{city} {dist} {road} {n}, {_d(r, 4)}호"
    if k == 6:
        return f"{city} {dist} {road} {n}"
    return f"{city} {_pick(r, ['새솔', '한들'])}{_pick(r, ['동', '읍', '면', '리'])} 산 {n}-{_d(r, 1)}"


def _korean_name(r) -> str:
    fam = _pick(r, FAMILY_TWO) if r.random() < 0.04 else FAMILY[min(int(r.exponential(12)), len(FAMILY) - 1)]
    k = r.random()
    if k < 0.55:
        i = int(r.integers(0, len(GIVEN) // 2)) * 2
        given = GIVEN[i : i + 2]
    elif k < 0.9:
        given = _pick(r, GIVEN) + _pick(r, GIVEN)
    else:
        given = "".join(_pick(r, GIVEN) for _ in range(_pick(r, [1, 3])))
    return fam + given


def _name(r) -> str:
    if r.random() < 0.3:
        return " ".join(w.capitalize() for w in (_pick(r, LATIN), _pick(r, LATIN)))
    return _korean_name(r)


FRAMES = {
    "email": ["{} 로 연락", "메일은 {} 여기로", "답장 주소: {}", "{} 로 이력서 보내주세요", "자료 필요하면 {} 로 연락주세요", "이메일 {}", "contact {}", "{}"],
    "phone": ["연락은 {} 로 주세요", "제 번호 {} 입니다", "급하면 {} 여기로 문자 남겨요", "문의 {}", "문의 {}", "☎ {} 24시간", "전화 {}", "call me {}", "{} 전화주세요", "번호는 {} 이에요", "{} 로 연락", "폰번호 {} 이에요"],
    "id_number": ["서류에 {} 라고 적혀있어요", "본인확인 {} 이거 맞나요", "{} 까지 달라고 하던데 괜찮나요", "주민번호 {} 라고", "여권번호 {} 입니다", "면허번호 {} 이거 맞나요", "주민 {} 라고", "본인확인 주민번호 {} 이거", "서류에 면허번호 {} 라고", "본인확인 여권번호 {} 이거"],
    "address": ["주소는 {} 입니다", "택배는 {} 로 보내주세요", "제가 사는 곳이 {} 인데요", "{} 로 오시면 돼요", "우리집 {} 이에요", "my address is {}", "주소 {}", "{}에서 만나요", "집 주소가 {} 이에요", "{} 1호관", "배송지: {}"],
    "name": ["제 이름은 {} 이고요", "예금주 {} 확인하세요", "담당자 {} 앞으로", "{} 씨가 알려줬어요", "{} 실장님 찾으시면 됩니다", "받는사람: {}", "본명은 {} 입니다", "{} 앞으로 보내주세요", "계약자 {} 확인", "저는 {} 입니다", "{} 선생님 소개로", "my name is {}", "성함은 {} 이에요", "{} 님 앞으로 입금", "{} 님 택배가 도착했어요", "{} 과장이 진행했습니다", "{} 씨한테 물어보세요", "{}님께 전달해주세요", "{} 드림", "{} 귀하", "받는사람: {}", "받는사람: {}", "보낸사람: {}", "{} 실장님 찾으시면 됩니다"],
}


def _harmless(r) -> str:
    t = _pick(r, TITLES)
    return _pick(
        r,
        [
            lambda: f"사업자번호 {_d(r, 3)}-{_d(r, 2)}-{_d(r, 5)} 래요",
            lambda: f"{_d(r, 3)}-{_d(r, 2)}-{_d(r, 5)}",
            lambda: f"운송장 {_d(r, 4)}-{_d(r, 4)}-{_d(r, 4)} 조회중이에요",
            lambda: f"주문번호 {_d(r, int(r.integers(6, 15)))}",
            lambda: f"주문번호 {_d(r, 8)}-{_d(r, 5)} 확인",
            lambda: f"{2020 + int(r.integers(0, 8))}-{_d(r, 2)}-{_d(r, 2)} {_d(r, 2)}:{_d(r, 2)} 까지래요",
            lambda: f"버전 {_d(r, 1)}.{_d(r, 2)}.{_d(r, 1)} 업데이트",
            lambda: f"IP {_d(r, 3)}.{_d(r, 1)}.{_d(r, 1)}.{_d(r, 2)} 차단됨",
            lambda: f"{_pick(r, ['1577', '1588', '070', '060', '080', '010'])}으로 시작하는 번호는 받지마세요",
            lambda: f"{_d(r, 3)}번 버스가 제일 빨라요",
            lambda: f"이번 달 {_d(r, 6)}명 방문",
            lambda: "주민번호 뒷자리는 ******* 처리하세요",
            lambda: f"{_pick(r, ['010-****-', '010-XXXX-'])}{_d(r, 4)} 로 온 문자",
            lambda: _pick(r, ["[전화번호] 로 연락주세요", "[이메일] 남겨주세요", "[주민번호] 는 왜 물어보죠", "[주소] 로 보내주세요", "[이름] 님"]),
            lambda: f"{_pick(r, FAMILY[:30])} {t}한테 물어봐요",
            lambda: f"{_pick(r, FAMILY[:30])}{t}이 그랬어요",
            lambda: f"{_pick(r, FAMILY[:30])} {t} 오셨어요",
            lambda: f"{_pick(r, NICK)}님 글 잘봤어요",
            lambda: f"{t} 앞으로 잘부탁드려요",
            lambda: f"앞으로 {_pick(r, WORDS)} 조심할게요",
            lambda: _pick(r, ["골뱅이무침 맛집이에요", "배고파 죽겠어요 진짜", "이거 진짜 최고네요", "신나는 노래 추천", "조심해서 가세요", "고마워요 정말", "장난감 보관했네요", "안경점 근처 구두는", "임시로 보관 중이에요", "강아지 새끼를 입양했어요"]),
            lambda: f"{_pick(r, ROADS)}{_pick(r, ['로', '길'])} 근처 {_pick(r, WORDS)}",
            lambda: f"{_pick(r, CITIES)}시 {_pick(r, DISTRICTS)}구 쪽에서 {_pick(r, WORDS)}",
            lambda: f"참고로 {_d(r, 3)}{_pick(r, ['번', '층', '시간', '만원', '호점', '킬로', '명', '장'])} 기다려서",
            lambda: f"{_existing(r)[_pick(r, [0, 1])]} 근처에서 {_pick(r, WORDS)}",
            lambda: f"{_pick(r, TOWNS)} 가는 기차표 {_d(r, 1)}장",
            lambda: f"{_pick(r, [*WARDS[:11], '서울', '시청', '대학'])}역 {_d(r, 1)}번 출구에서 {_pick(r, WORDS)}",
            lambda: f"경비아저씨가 {_pick(r, WORDS)}",
            lambda: " ".join(w.capitalize() for w in (_pick(r, ["secret", "sky", "top", "hope", "best"]), _pick(r, ["box", "bar", "spa", "10", "3"]))) + " 매장 " + _d(r, 3) + "호점",
            lambda: f"담당자 덕분에 {_pick(r, WORDS)}",
            lambda: f"담당자는 {_pick(r, WORDS)}",
            lambda: f"{_pick(r, ['never got ironed', 'honestly waited', 'minutes', 'speaking', 'the twins met', 'At rush hour,'])} at {_pick(r, ['the parking deck', 'the bank lobby', 'rush hour', 'home', 'the night market', 'noon', 'work'])} {_pick(r, ['we quickly unplugged', 'and left', 'again', '.'])}",
            lambda: f"They met near the {_pick(r, ['Old Town', 'North Gate', 'City Hall'])} at {_d(r, 2)}",
        ],
    )()


def sentences(count: int, seed: int, carriers: list[str]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """``count`` labelled texts: ``(text, [(begin, end, type number)])``."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(int(r.integers(1, 4))):
            k = r.random()
            if k < 0.42:
                j = int(r.integers(0, len(TYPES)))
                frame = _pick(r, FRAMES[TYPES[j]])
                val = [_email, _phone, _id, _address, _name][j](r)
                if TYPES[j] == "name" and not val.isascii() and ("실장님" in frame or "선생님" in frame) and len(val) < 3:
                    val += _pick(r, GIVEN)
                a = frame.index("{}")
                spans.append((len(text) + a, len(text) + a + len(val), j))
                text += frame.replace("{}", val)
            elif k < 0.62:
                text += _harmless(r)
            elif carriers and k < 0.92:
                c = _pick(r, carriers)
                a = int(r.integers(0, max(len(c) - 60, 1)))
                text += c[a : a + int(r.integers(15, 70))]
            else:
                text += " ".join(_pick(r, WORDS) for _ in range(int(r.integers(2, 8))))
            text += _pick(r, [" ", " ", " ", "\n", ". ", " / ", "!! ", " ㅋㅋ "])
        text = text.rstrip(" ")
        out.append((text, spans))
    return out


# symbols of the tagger: separators, classes, and frequent characters of their own
_SEP, _UNK, _HANGUL, _OTHER_LETTER = 0, 1, 2, 3
_OWN = "01 @.-_:/()[]*+,!?~#\n―–'\"☎"


class Alphabet:
    """Code point -> symbol. Digits but 0 and 1 are one symbol, Latin letters are capitals, small or one of the
    letters of address words; syllables that are rare in the training texts are one symbol."""

    def __init__(self, texts: list[str], size: int = 700):
        self.table = np.full(0x10000, _UNK, np.int16)
        self.table[0xAC00:0xD7A4] = _HANGUL
        self.table[0xC0:0x1200] = _OTHER_LETTER
        self.table[0x3040:0xA000] = _OTHER_LETTER
        nxt = 4
        for c in _OWN:
            self.table[ord(c)] = nxt
            nxt += 1
        self.table[ord("2") : ord("9") + 1] = nxt
        self.table[ord("A") : ord("Z") + 1] = nxt + 1
        nxt += 2
        for c in range(ord("a"), ord("z") + 1):
            self.table[c] = nxt
            nxt += 1
        n = np.zeros(0x10000, np.int64)
        for t in texts:
            for c in t:
                if "가" <= c <= "힣" or "ㄱ" <= c <= "ㆎ":
                    n[ord(c)] += 1
        for c in np.argsort(-n, kind="stable")[:size]:
            if n[c] >= 8:
                self.table[c] = nxt
                nxt += 1
        self.size = nxt

    def of(self, cp: np.ndarray) -> np.ndarray:
        return self.table[np.minimum(cp, 0xFFFF)]


def fit(carriers: list[str], count: int = 9000, hidden: int = 16, epochs: int = 5, batch: int = 48, seed: int = 11) -> tuple[tagger.Params, Alphabet]:
    data = sentences(count, seed, carriers)
    ab = Alphabet([t for t, _ in data])
    r = np.random.default_rng(seed)
    xs, ys = [], []
    for t, spans in data:
        x = ab.of(np.array([ord(c) for c in t], np.uint32)).astype(np.int64)
        drop = (x >= 4) & (r.random(len(x)) < 0.04) & np.array(["가" <= c <= "힣" for c in t])
        x[drop] = _HANGUL
        y = np.zeros(len(x), np.int64)
        for a, b, j in spans:
            y[a] = 1 + 2 * j
            y[a + 1 : b] = 2 + 2 * j
        xs.append(np.r_[_SEP, x, _SEP])
        ys.append(np.r_[0, y, 0])
    return tagger.train(xs, ys, ab.size, K, hidden, epochs, batch, seed), ab


# Exact checks of a span's shape.
_EMAIL = re.compile(r"[\w.+-]+\s?(?:@|\[at\]|\(at\)|\(?골뱅이\)?)\s?\w|[\w.+-]+ at [\w-]+(?:\s?(?:\bdot\b|\.|쩜|\[dot\])\s?[\w-]+)+", re.I)
_DATE = re.compile(r"(?:19|20)\d\d[-./]\d\d?[-./]\d\d?")
_ROAD = re.compile(r"[가-힣]+(?:로|길)\s?\d|번길|번지|\d+-\d+|산\s?\d|\d+\s+\S+-(?:ro|gil|daero)|동\s?\d", re.I)
_LATIN_NAME = re.compile(r"^[A-Z][a-z]+(?: [A-Z][a-z]+)+$")
_HANGUL_NAME = re.compile(r"^[가-힣]{2,5}$")


_SPOKEN = str.maketrans("Oo" + HANGUL_DIGITS, "000123456789"[:2] + "0123456789")


def shaped(kind: str, s: str) -> bool:
    s = s.strip(" .,/:")
    if kind == "email":
        return bool(_EMAIL.search(s))
    digits = re.sub(r"\D", "", s.translate(_SPOKEN))
    if kind == "phone":
        if re.fullmatch(r"\d{3}-\d{2}-\d{5}|\d{4}-\d{4}-\d{4}|\d+(?:\.\d+){3}", s) or _DATE.match(s) or "*" in s:
            return False
        return 8 <= len(digits) <= 13 and (digits[0] == "0" or s.startswith("+") or digits.startswith("82"))
    if kind == "id_number":
        if re.fullmatch(r"[A-Za-z]{1,2}\s?\d{7,8}", s) or re.fullmatch(r"\d{2}-\d{2}-\d{6}-\d{2}", s):
            return True
        return len(digits) == 13 and "01" <= digits[2:4] <= "12" and "01" <= digits[4:6] <= "31" and bool(re.fullmatch(r"\d{6}\s?\D{0,2}\s?\d{7}", s))
    if kind == "address":
        return bool(re.search(r"\d", s)) and bool(_ROAD.search(s))
    if _LATIN_NAME.match(s):
        return True
    return bool(_HANGUL_NAME.match(s)) and (s[0] in FAMILY or s[:2] in FAMILY_TWO) and not any(s.endswith(t) for t in TITLES)


# What a name is given after.
_NAME_CUE = re.compile(r"(?:(?:예금주|입금자|수취인|계약자|신청자|담당자|예약자|받는\s?(?:사람|분|이)|보내는\s?(?:사람|분|이))(?:명)?(?:은|는|이|가)?|(?:본명|실명|이름|성함|성명)(?:은|이)?)\s*[:：=]?\s*$")


def _stands_alone(name: str, before: str, after: str) -> bool:
    """A name is a word of its own; two syllables, which common words share, need a cue before or a form of address,
    or the end of a letter, after them."""
    if before[-1:].isalnum():
        return False
    if _HANGUL_NAME.match(name):
        if len(name) == 2 and name not in FAMILY_TWO:
            return bool(re.match(r"\s?(?:씨|님|실장|선생|이고|앞으로|드림|올림|배상|귀하)", after) or _NAME_CUE.search(before) or re.search(r"저는\s*$", before) and re.match(r"\s?입니다", after))
        return not name.endswith(("하다", "해요", "네요", "어요"))
    return True


def spans_of(texts: pa.Array, model: tuple[tagger.Params, Alphabet]):
    """``(row, begin, end, type number)`` arrays; places are those of the original text."""
    params, ab = model
    cp, off, _ = explode(texts)
    form, foff, src = unify(cp, off, sources=True)
    n = len(foff) - 1
    # one stream: every text has a separator before and after
    size = np.diff(foff)
    soff = np.zeros(n + 1, np.int64)
    np.cumsum(size + 1, out=soff[1:])
    stream = np.full(int(soff[-1]) + 1, _SEP, np.int64)
    place = np.arange(len(form)) + np.repeat(np.arange(n), size) + 1
    stream[place] = ab.of(form)
    em = tagger.emissions(params, stream)
    tags = tagger.decode(params, em[place], foff)
    hot = np.flatnonzero(tags > 0)
    out = []
    if len(hot):
        row = np.searchsorted(foff, hot, "right") - 1
        kind = (tags[hot] - 1) // 2
        new = np.r_[True, (hot[1:] != hot[:-1] + 1) | (kind[1:] != kind[:-1]) | (row[1:] != row[:-1]) | (tags[hot][1:] % 2 == 1)]
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(hot)] - 1
        for a, b in zip(first, last):
            x, y = int(hot[a]), int(hot[b]) + 1
            i, k = int(row[a]), int(kind[a])
            lo, hi = int(foff[i]), int(foff[i + 1])
            if k in (1, 2):  # a number is taken whole
                while x > lo and 48 <= form[x - 1] <= 57:
                    x -= 1
                while y < hi and 48 <= form[y] <= 57:
                    y += 1
            s = form[x:y].tobytes().decode("utf-32-le")
            if k == 1 and shaped("id_number", s):
                k = 2
            around = form[max(x - 12, lo) : x].tobytes().decode("utf-32-le"), form[y : min(y + 4, hi)].tobytes().decode("utf-32-le")
            if shaped(TYPES[k], s) and (k != 4 or _stands_alone(s, *around)):
                end = int(src[y]) if y < foff[i + 1] else int(off[i + 1])
                begin = int(src[x])
                out.append((i, begin - int(off[i]), end - int(off[i]), k))
    return cp, off, out


_CUES = re.compile(r"이름|예금주|앞으로|찾으시면|받는|씨가|본명|번지|번길|\d{5}|\d-\d|@|at\]|골뱅이|[로길] ?\d|-ro|공1공|[A-Z][a-z]+ [A-Z]|주민|여권|면허")


@functools.cache
def _trained(carriers: tuple[str, ...]) -> tuple[tagger.Params, Alphabet]:
    return fit(list(carriers))


def model(df: DataFrame, key: str, text: str, sample: int = 400) -> tuple[tagger.Params, Alphabet]:
    """Trains the tagger; ``sample`` rows, drawn by the hash of their key, lend their sentences as carriers. Sample
    rows with anything that looks like a cue of personal data are left out, since they carry no labels."""
    some = df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null").withColumn("h", F.xxhash64("k")).orderBy("h", "k", "t").limit(sample).collect()
    return _trained(tuple(sorted(r.t for r in some if len(r.t) >= 3 and not _CUES.search(r.t))))


def find(df: DataFrame, key: str, text: str, fitted=None) -> DataFrame:
    """``(key, begin, end, pii_type)`` per span of ``text``, in characters of the original.

    Null texts and null keys have no spans; rows that repeat a key are read each. Empty input gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(fitted or model(df, key, text))
    kind = dict(df.dtypes)[key]

    def run(batches):
        m = shared.value
        for b in batches:
            _, _, spans = spans_of(b.column(1), m)
            row = pa.array([s[0] for s in spans], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(row), pa.array([s[1] for s in spans], pa.int64()), pa.array([s[2] for s in spans], pa.int64()), pa.array([TYPES[s[3]] for s in spans], pa.string())],
                names=["key", "begin", "end", "pii_type"],
            )

    return df.select(key, text).where(F.col(text).isNotNull()).mapInArrow(run, f"key {kind}, begin long, end long, pii_type string")


def masked(df: DataFrame, key: str, text: str, fitted=None) -> DataFrame:
    """``(key, masked, spans)``: every row, its text with typed placeholders for the spans; nulls stay null."""
    shared = df.sparkSession.sparkContext.broadcast(fitted or model(df, key, text))
    kind = dict(df.dtypes)[key]

    def run(batches):
        m = shared.value
        for b in batches:
            texts = b.column(1)
            _, _, spans = spans_of(texts, m)
            out, count = texts.to_pylist(), [0] * b.num_rows
            for i, a, e, k in reversed(spans):
                out[i] = out[i][:a] + PLACEHOLDER[TYPES[k]] + out[i][e:]
                count[i] += 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(count, pa.int64())], names=["key", "masked", "spans"])

    return df.select(key, text).mapInArrow(run, f"key {kind}, masked string, spans long")
