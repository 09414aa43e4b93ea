from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadloom.llm import garbled, packing, pii, tagger
from threadloom.session import table


def test_gradients():
    r = np.random.default_rng(0)
    p = tagger.Params(7, 3, 4, 1)
    p.v = {k: w.astype(np.float64) for k, w in p.v.items()}
    x, y = r.integers(0, 7, (6, 3)), r.integers(0, 4, (6, 3))
    m = np.ones((6, 3), bool)
    m[4:, 1] = False
    _, g = tagger.loss_and_grads(p, x, y, m)
    for k, i in {"table": (0, x[2, 0], 5), "u": (1, 2, 7), "out": (4, 1), "bias": (2,), "trans": (1, 3), "start": (0,)}.items():
        o = p.v[k][i]
        p.v[k][i] = o + 1e-3
        a, _ = tagger.loss_and_grads(p, x, y, m)
        p.v[k][i] = o - 1e-3
        b, _ = tagger.loss_and_grads(p, x, y, m)
        p.v[k][i] = o
        assert g[k][i] == pytest.approx((a - b) / 2e-3, abs=2e-4)


def test_decode_against_all_paths():
    import itertools

    r = np.random.default_rng(3)
    p = tagger.Params(5, 2, 3, 1)
    p.v["trans"], p.v["start"] = r.standard_normal((3, 3)), r.standard_normal(3)
    sizes = [5, 0, 1, 4]
    off = np.r_[0, np.cumsum(sizes)]
    em = r.standard_normal((off[-1], 3)) * 2
    tags = tagger.decode(p, em, off)
    for a, b in zip(off, off[1:]):
        if b > a:
            score = lambda s, a=a: p.v["start"][s[0]] + sum(em[a + i, t] for i, t in enumerate(s)) + sum(p.v["trans"][x, y] for x, y in zip(s, s[1:]))
            assert tuple(tags[a:b]) == max(itertools.product(range(3), repeat=b - a), key=score)


@pytest.fixture(scope="module")
def model():
    return pii.fit([])


def test_held_out_sentences(model):
    data = pii.sentences(500, 77, [])
    texts = [t for t, _ in data]
    _, _, spans = pii.spans_of(pa.array(texts), model)
    got = {(i, k) for i, _, _, k in spans}
    want = {(i, k) for i, (_, s) in enumerate(data) for _, _, k in s}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.03 * len(got)


def test_masking(spark, model):
    import unicodedata

    rows = [
        (1, "연락은 ０１０－１２３４－５６７８ 로 주세요 ㅋㅋ"), (2, "제 이름은 한가람 이고요. 메일은 kim.lee@example.com 여기로"), (3, None), (4, ""),
        (5, "사업자번호 123-45-67890 래요"), (6, unicodedata.normalize("NFD", "예금주 이은별 확인하세요")), (7, "맞아요 " * 30000 + "제 번호 010-1111-2222 입니다"), (7, "김 실장님한테 물어봐요"),
    ]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("masked", F.lit(1)).withColumn("begin", F.lit(1))
    got = {}
    for r in pii.masked(df, "id", "text", model).collect():
        got.setdefault(r.key, []).append((r.masked, r.spans))
    assert got[1] == [("연락은 [PHONE] 로 주세요 ㅋㅋ", 1)] and got[2] == [("제 이름은 [NAME] 이고요. 메일은 [EMAIL] 여기로", 2)]
    assert got[3] == [(None, 0)] and got[4] == [("", 0)] and got[5][0][1] == 0 and "[NAME]" in got[6][0][0]
    assert sorted(n for _, n in got[7]) == [0, 1]
    assert pii.find(df.limit(0), "id", "text", model).collect() == []


def test_names_of_two_syllables(model):
    texts = ["예금주 김솔 확인하세요", "받는사람: 김솔", "본명은 김솔 입니다", "김솔 드림", "담당자 김솔 앞으로", "저는 김솔 입니다", "김솔 귀하", "이건 정말 좋아요", "택배가 이제 오네요"]
    _, _, spans = pii.spans_of(pa.array(texts), model)
    assert [(i, texts[i][a:b]) for i, a, b, _ in spans] == [(i, "김솔") for i in range(7)]


GARBLE = [("utf-8", "cp1252"), ("utf-8", "mac_roman"), ("cp949", "cp1252")]


def test_round_trips(spark):
    d = "/root/testdata/sf0.01"
    docs = table(spark, d, "documents", "doc_id", "text")
    m = garbled.model(docs, "doc_id", "text")
    clean = ["오늘 지하상가에서 구두를 수선했어요. 값은 22만원이라고 하네요.", "Le gérant a réparé la machine à laver, même à la gare.", "ATENÇÃO: NÃO deixem o carregador na estação, já sumiram 28 coisas.", "She said “no refunds” – twice 😅", "先週駅前で靴を修理しました。"]
    label = lambda t: garbled.label([np.array([ord(c) for c in t], np.uint32)], m)[0]
    restored = lambda t: garbled.restore([t], [label(t)], m)[0]
    assert not any(label(t).any() for t in clean)
    for wrote, read in GARBLE:
        t = clean[0]
        bad = "앞부분은 멀쩡해요.\n" + garbled.read_as(t.encode(wrote), read)
        assert restored(bad)[:2] == ("앞부분은 멀쩡해요.\n" + t, True)
    twice = garbled.read_as(garbled.read_as(clean[1].encode(), "cp1252").encode(), "cp1252")
    assert restored(twice)[:2] == (clean[1], True)
    lost = clean[0].encode("cp949").decode("utf-8", "replace")
    assert label(lost).any() and not restored(lost)[1]
    df = spark.createDataFrame([(1, None), (2, ""), (3, clean[0]), (4, clean[0] * 2000 + lost), (4, twice)], "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("whole", F.lit(1))
    assert sorted((r.key, r.whole) for r in garbled.find(df, "doc_id", "text", fitted=m).collect()) == [(4, False), (4, True)]
    assert garbled.find(df.limit(0), "doc_id", "text").collect() == []


GENUINE = [
    "“curly” ‘quotes’ … – —", "“Hello” – she said… ‘why’", "‘Ok’ ’90s — “yes”", "It’s “fine” — really…", "That’s €12 per shift…",
    "L’ÉTÉ à Paris, façade, œuvre – 50 €", "«Où est la clé ?» — À côté… ÉÈÊ", "¿Qué? ¡No! «SÁBADO» — la señora dijo “sí”…", "NÃO, AÇÃO, ÇÃO — «José» disse “não”…",
    "„Grüße“ – ‚Öl‘ … ÄÖÜ", "그는 “아니요”라고 했어요… ‘왜’ – 50€ 라서", "「彼は“はい”と言った…」—‘OK’ 50€", "Łódź — „tak”… ŻÓŁĆ", "ok � ok",
]


def test_genuine_typography_is_no_case(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents", "doc_id", "text")
    for m in (garbled.model(docs, "doc_id", "text"), garbled.fit({ord(c): 500 for c in "오늘은 수선했어요 the of and"}, ["오늘 구두를 수선했어요."])):
        assert [t for t, p in zip(GENUINE, garbled.label([np.array([ord(c) for c in t], np.uint32) for t in GENUINE], m)) if p.any()] == []


def test_every_document_is_garbled_for_the_model(spark):
    """What only a few of many documents garble to is in the model, in whatever order their keys come."""
    texts = ["수선 � 맡겼어요\n오늘 구두를 수선했어요."] * 3000 + ["先週駅前で靴を修理しました。\n값은 같아요 " + "뷁" * 3, None, "ascii only", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    # by the parts of texts, each by itself
    for s, (_, wrote, read) in list(enumerate(garbled.PAIRS))[garbled.STRUCT :]:
        seen = Counter()
        for t in filter(None, texts):
            for part in t.split("\n"):
                raw = part.encode(wrote, "ignore")
                lost = len(part) - len(raw.decode(wrote, "ignore"))
                if "�" not in part and not raw.isascii() and lost <= 0.02 * len(part):
                    seen.update(c for c in raw.decode(read, "replace") if ord(c) >= 0x80)
        for flip in (1, -1):
            m = garbled.model(df.select((F.col("k") * flip).alias("k"), "t"), "k", "t")
            some = [c for c, n in seen.items() if n > 1 and c != "\ufffd" and not 0x80 <= ord(c) < 0xA0]
            want = np.clip([np.log(seen[c] / sum(seen.values())) - m.logp[ord(c)] for c in some], -8, 8)
            assert some and np.allclose(m.ratio[s, [ord(c) for c in some]], want, atol=1e-4)


def test_two_byte_encodings_read_as_western(spark):
    m = garbled.model(table(spark, "/root/testdata/sf0.1", "documents", "doc_id", "text"), "doc_id", "text")
    for wrote, t in (("shift_jis", "先週駅前で靴を修理しましたが、とても便利だと聞きました。"), ("cp949", "지하상가 근처 수선집은 미리 예약해야 하더라고요.")):
        bad = garbled.read_as(t.encode(wrote), "cp1252")
        path = garbled.label([np.array([ord(c) for c in bad], np.uint32)], m)[0]
        assert garbled.restore([bad], [path], m) == [(t, True, [f"{wrote}>cp1252"])]


def check(rows, capacity):
    by, place = {}, {}
    for r in rows:
        by[r.container] = by.get(r.container, 0) + r.size
        place.setdefault(r.container, []).append(r.place)
    assert max(by.values()) <= capacity
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in place.values())
    return by


@pytest.mark.parametrize("per", [50_000, 150])
def test_packing(spark, per):
    r = np.random.default_rng(2)
    sizes = [int(x) for x in np.minimum(r.lognormal(3, 1, 900), 250)] + [100, 100, 51, 49, 1, 350, 0, -3, None]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, n long").withColumn("size", F.lit("x")).withColumn("room", F.lit(0))
    rows = packing.pack(df, "id", "n", 100, per_range=per).collect()
    by = check(rows, 100)
    want = sum(s for s in sizes if s and s > 0)
    assert sum(by.values()) == want and len(by) <= 1.12 * want / 100
    got = {}
    for x in rows:
        got.setdefault(x.key, []).append(x.size)
    assert all(sum(got[i]) == s and len(got[i]) == -(-s // 100) for i, s in enumerate(sizes) if s and s > 0)


def test_packing_ends(spark):
    df = spark.createDataFrame([(i, 7) for i in range(300)], "id long, n long")
    assert len(check(packing.pack(df, "id", "n", 100, per_range=64).collect(), 100)) <= 24
    assert packing.pack(df.limit(0), "id", "n").collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, "id", "n", 0)


def test_tokens(spark):
    df = spark.createDataFrame([("hello world",), ("",), (None,), ("가나다" * 3000,)], "t string")
    n = [r.n for r in df.select(packing.token_count(F.col("t")).alias("n")).collect()]
    assert n[0] == len(packing.encoder(packing.TOKENIZER).encode_ordinary("hello world")) and n[1:3] == [0, 0] and n[3] > 3000
