import pytest
from pyspark.sql import functions as F

from threadloom.llm import abuse, pairs
from threadloom.session import table

INS = "[POST-TITLE] 지하상가 구두 수선 질문\n[POST-BODY] 구두를 수선하려고 지하상가에 갔다가 옆 가게에서 기다렸어요."
LONG = "어제 친구와 시장에 들러서 커튼을 천천히 골랐어요. 값은 생각보다 비쌌지만 색이 마음에 들었네요"


def test_defects(spark):
    rows = [
        (1, INS, "[3-1] ​", "empty"), (2, INS, None, "empty"), (3, INS, "[1] ...", "empty"), (4, INS, "ㅇㅇ", None), (5, INS, "1", None),
        (6, INS, "구두를 수선하려고 지하상가에 갔다가 옆가게에서 기다렸어요 ㅠㅠ", "copy"), (7, INS, "지하상가 구두 수선 질문", "copy"),
        (8, INS, "> 지하상가 구두 수선 질문\n" + LONG + ".", None),
        (9, INS, "죄송하지만 해당 요청에는 답변을 드릴 수 없습니다.", "refusal"), (10, INS, "I'm sorry, but I can't help with that request.", "refusal"),
        (11, INS, "Lo siento, pero no puedo responder a eso.", "refusal"), (12, INS, "답변이 늦어서 죄송해요 " + LONG + ".", None),
        (13, INS, "The weather was nice, so we walked to the harbour and waited for the last boat.", "other_language"),
        (14, INS, "今日は駅前で靴を修理してもらいましたが、とても便利でした。", "other_language"),
        (15, INS, LONG + " 첫째,", "truncated"), (16, INS, LONG + '. 사장님 말로는 "구두를 고치면', "truncated"), (17, INS, LONG + " 정리하면 1) 구두 수선하기 2) 커튼 챙기기 3)", "truncated"),
        (18, INS, LONG + " 정리하면 1) 구두 수선하기 2) 커튼 챙기기 3) 가게에서 확인하기", None), (19, None, LONG + ".", None),
        (20, "[POST-TITLE] Where do you repair shoes around here?\n[POST-BODY] The tailor told me to wait for a week.", "I took mine to the stall near the gate and they were done before noon. I would also say that", "truncated"),
        (21, INS, (LONG + ". ") * 300, None), (22, "", "", "empty"),
    ]
    filler = [(100 + i, INS, f"{LONG}. 그 다음에는 {i}번 버스를 탔어요. 집에 와서 정리했네요.", None) for i in range(60)]
    filler += [(300 + i, INS, f"We waited {i} minutes at the gate. They closed early.", "other_language") for i in range(40)]
    df = spark.createDataFrame(rows + filler, "row_id long, instruction string, output string, want string").withColumn("defect", F.lit("x"))
    got = {r.key: r.defect for r in pairs.defects(df, "row_id", "instruction", "output").collect()}
    assert {k: got.get(k) for k, *_ in rows} == {k: w for k, _, _, w in rows}
    assert all(got.get(k) == w for k, _, _, w in filler)
    assert pairs.defects(df.limit(0), "row_id", "instruction", "output").collect() == []


def test_language_of_the_training_sentences():
    import pyarrow as pa

    from threadloom.functions.codepoints import explode

    names = sorted(pairs.SENTENCES)
    best, odds = pairs.languages(*explode(pa.array([pairs.SENTENCES[k] for k in names]))[:2])
    assert [pairs.language_model()[0][b] for b in best] == names and (odds > 6).all()


@pytest.mark.parametrize("text", ["시1발 뭐냐", "씨.발", "ㅅㅣㅂㅏㄹ", "ㅅㅂ들아", "tlqkf 아니냐", "야 개 새 끼아", "벼엉신", "등등신", "씨​발", "네 낯짝 보면 토 나온다 쓰레기야", "틀딱들은 다 내쫓아야 한다", "send nudes, wanna f*ck tonight", "역시 난민 종특이지 더럽다", "쎅스하고 싶어"])
def test_caught(text):
    import pyarrow as pa

    from threadloom.llm.visual import unify_array

    assert abuse.score_text(unify_array(pa.array([text]))[0].as_py())[0] >= abuse.CASE


@pytest.mark.parametrize("text", ["오늘이 새로운 시발점이 되겠네요", "새끼손가락 다쳐서 밴드 붙였어요", "신발 한 켤레 샀어요", "닥쳐올 추위에 대비해요", "배고파 죽겠어요 진짜", "씨발라먹기 귀찮은 수박", "병신년 달력을 아직 갖고 있더라", "섹시한 빨간색 구두 추천해요", "Scunthorpe 라는 동네 이름이 특이하네요", "장애인 주차구역은 비워두세요", "외국인 손님이 친절했어요", "늦게 자지 말고 일찍 쉬어요", "", "​"])
def test_harmless(text):
    assert abuse.score_text(text)[0] < abuse.CASE


def test_levenshtein_walk_against_table():
    def cost(a, b):  # weighted distance of term b to the best beginning of word a, cell by cell
        row = [0.0]
        for j in range(len(a)):
            row.append(row[-1] + abuse._gap(a[j], a[j - 1] if j else ""))
        last = ""
        for c in b:
            new = [row[0] + abuse._gap(c, last)]
            for j in range(1, len(a) + 1):
                new.append(min(row[j - 1] + abuse._sub(a[j - 1], c), row[j] + abuse._gap(c, last), new[j - 1] + abuse._gap(a[j - 1], a[j - 2] if j > 1 else "")))
            row, last = new, c
        return min(row)

    t = abuse.Trie()
    terms = ["시발", "병신", "개새끼", "또라이새끼", "미친놈"]
    for w in terms:
        t.add(abuse.letters(w), w, 1.0, abuse._budget(len(abuse.letters(w))))
    for word in ["쉬발아", "벼엉신", "개색끼", "또라이섀끼", "미췬놈", "신발", "시달려", "개나리", "병원", "미친듯이"]:
        key = abuse.letters(word)
        want = {w for w in terms if cost(key, abuse.letters(w)) <= abuse._budget(len(abuse.letters(w)))}
        assert {m for m, _, _ in abuse.match(key, t)} == want


def test_scores_and_rates(spark):
    rows = [(1, "야 씨발아 그만 좀 해라", "a"), (2, "맞아요", "a"), (3, None, "a"), (4, "", None), (5, "맞아요 " * 20000 + "병신", "b"), (6, "맞아요", "b")]
    df = spark.createDataFrame(rows, "valid_id long, text string, board string").withColumn("score", F.lit(0)).withColumn("terms", F.lit(0))
    s = {r.valid_id: r.s for r in df.select("valid_id", abuse.scored(F.col("text")).alias("s")).collect()}
    assert s[1].score >= 1 and s[2].score == 0 and s[3] is None and s[4].score == 0 and s[5].score >= 1
    assert {tuple(r) for r in abuse.rates(df, "text", "board").collect()} == {("a", 2, 1, 0.5), (None, 1, 0, 0.0), ("b", 2, 1, 0.5)}
    assert abuse.rates(df.limit(0), "text", "board").collect() == []


def test_against_reviewed_sample(spark):
    d = "/root/testdata/sf0.01"
    v = table(spark, d, "valid", "valid_id", "text").join(table(spark, d, "valid_labels", "valid_id", "abusive"), "valid_id")
    got = v.select("abusive", (abuse.scored(F.col("text")).getField("score") >= abuse.CASE).alias("hit")).collect()
    assert sum(bool(r.abusive) == r.hit for r in got) >= 0.98 * len(got)


@pytest.mark.parametrize("text", ["너병신이냐", "존나씨발", "진짜병신같네", "완전 너병1신이네", "이런쉬발", "완전벼엉신이네", "저런병신같은놈", "개같은씨발놈아", "이런저런그런완전진짜정말개같은병신이네", "야 시 발 아 진 짜 그 만", "you are an idiot", "너 진짜 쓰레기야"])
def test_strong_terms_inside_a_word(text):
    assert abuse.score_text(text)[0] >= abuse.CASE


@pytest.mark.parametrize("text", ["전염병 예방", "질병신고", "다시발송 했어요", "3개년 계획", "초등신입생", "미성년자위반", "건강간식", "다시.발송", "외국인 난민 지원 센터에서 장애인 봉사했어요", "외국인 등록증 취급 은행", "얼굴 보고 싶다 쪽지 줘", "다시팔았다는 얘기", "그랜드캐년 여행"])
def test_harmless_inside_a_word(text):
    assert abuse.score_text(text)[0] < abuse.CASE


def test_copies_refusals_and_short_ends_without_cut_offs():
    ends = pairs.Endings.__new__(pairs.Endings)
    ends.whole = lambda t: 1.0
    title = "주말에 보증금 돌려받는 방법 아시는 분 계신가요 알려주세요"
    why = "이 주제는 개인의 사정에 따라 달라지고 확인할 자료도 없어서 무엇이 맞는지 판단하기 어렵습니다. " * 6
    outputs = ["아" + title + "요", "죄송하지만 답변을 드릴 수 없습니다. " + why, "죄송하지만 답변을 드릴 수 없습니다. 대신 이렇게 해보세요. " + why, "그건 집에서,", "인정"]
    got = pairs.judge([f"[POST-TITLE] {title}\n[POST-BODY] 궁금합니다"] * 5, outputs, ends)
    assert got == ["copy", "refusal", None, "truncated", None]


def test_one_rule_for_scripts_with_few_and_many_rows(spark):
    cut, whole = "We waited at the counter for a while and then the", "We waited at the counter for a while. Then they closed."
    for n in (1, 19, 20, 21, 300):
        rows = [(i, None, f"They repaired the lamp in {i} days. I paid at the counter.") for i in range(n)] + [(-1, None, cut), (-2, None, whole)]
        df = spark.createDataFrame(rows, "row_id long, instruction string, output string")
        assert [tuple(r) for r in pairs.defects(df, "row_id", "instruction", "output").collect()] == [(-1, "truncated")]


def test_refusals_by_place_and_not_by_length():
    why = "그 부분은 사정에 따라 다르고 자료도 부족해서 판단이 어려운 것 같습니다. "
    for n in (0, 3, 12, 200):
        assert pairs.refuses("죄송하지만 답변을 드릴 수 없습니다. " + why * n) and pairs.refuses(why * n + "그래서 답변을 드릴 수 없습니다.")
        assert not pairs.refuses("죄송하지만 답변을 드릴 수 없습니다. 대신 이렇게 해보세요. " + why * n)


def test_counters_are_summed_over_partitions(spark):
    import numpy as np

    from threadloom.operators.counting import slot_counts

    df = spark.range(1000).repartition(7)
    got = slot_counts(df, 70_000, lambda b, acc: np.add.at(acc, b.column(0).to_numpy() * 69, 2))
    assert got.sum() == 2000 and (got[::69][:1000] == 2).all() and (slot_counts(df.limit(0), 5, lambda b, acc: None) == 0).all()
