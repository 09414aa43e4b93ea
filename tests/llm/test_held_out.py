"""Texts of other kinds than the test tables, written for this file before it was run; the bounds are what was measured, 7 with one to spare."""

import pyarrow as pa

from threadloom.llm import abuse, pii
from threadloom.llm.visual import unify_array

ABUSIVE = [
    "이 등신아 그것도 못하냐", "진짜 지랄하고 자빠졌네", "너 같은 병신은 처음 본다", "씨발 또 늦었잖아", "야이 개새끼야 돈 내놔", "저 미친년이 또 거짓말하네", "그 새끼 완전 또라이야", "좆같은 회사 때려치운다", "니 애미 창녀", "입 닥쳐 병신아",
    "틀딱들 투표권 뺏어야 됨", "맘충들 때문에 카페를 못 가겠다", "짱깨들은 다 추방해라", "흑인들은 더럽다 미개해", "장애인 새끼들 극혐", "너 죽여버린다", "골목에서 만나면 패버린다", "섹스하자 연락해", "가슴 만지고 싶다", "야동 보내줘",
    "what a fucking moron you are", "shut up you stupid bitch", "go kill yourself you worthless trash", "all of them are retards", "you are an asshole", "ㅅㅂ 진짜 짜증나네", "ㅂㅅ같은 놈", "ㅈㄹ하네", "씨이발 뭐라는거야", "개.새.끼", "미친놈아 정신차려", "쌍놈의 자식", "나가 뒈져라", "한남충 특징이지 뭐", "보지년아", "tlqkf 진짜", "병1신 같은 소리", "김치녀들 답없다", "엠창인생", "염병하네 진짜",
]
HARMLESS = [
    "오늘 날씨 정말 좋네요", "시발점은 작은 실수였다", "개나리가 활짝 피었어요", "병원에 신고하고 왔습니다", "새끼 고양이를 입양했어요", "미친 듯이 웃었다", "이 식당 미쳤다 진짜 맛있어", "죽을 만큼 보고 싶다", "배고파 죽겠네", "어깨가 뒤져서 아파요",
    "외국인 친구와 서울 구경했어요", "장애인 편의시설을 늘려야 합니다", "난민 지원 봉사를 다녀왔습니다", "흑인 음악을 좋아해요", "여자들끼리 여행 갔어요", "노인네들 건강이 걱정돼요", "가슴이 답답해서 병원에 갔다", "가슴 뭉클한 영화였어요", "엉덩이 근육 운동 추천", "모텔 대신 호텔 예약했어요",
    "욕설이라는 단어의 어원을 찾아봤다", "병신년은 육십갑자의 하나이다", "자위대 관련 뉴스를 봤다", "섹스폰 연주가 좋았어요", "색소폰을 배우고 있어요", "쓰레기 분리수거는 수요일입니다", "쓰레기통이 꽉 찼어요", "this movie is so good", "the idiot is a novel by dostoevsky", "he works at a trash recycling plant", "scunthorpe united won", "assess the class before grass grows", "야한 시간까지 일했네", "밤길이 어두우니 조심하세요", "꺼져 있던 불을 켰다", "벌레가 나왔어요 도와주세요", "얼굴에 뭐가 났어요", "찍은 사진 공유할게요", "등신대 피규어를 샀다", "한강 간식 추천해요",
]


def _cases(texts):
    return [abuse.score_text(t)[0] >= abuse.CASE for t in unify_array(pa.array(texts)).to_pylist()]


def test_abuse_on_fresh_texts():
    hit, false = sum(_cases(ABUSIVE)), sum(_cases(HARMLESS))
    print("abusive found", hit, "of", len(ABUSIVE), "harmless taken", false, "of", len(HARMLESS))
    assert hit >= 38 and false <= 1


PERSONAL = [
    ("오늘 회의는 박지훈 과장이 진행했습니다. 연락처는 010-2345-6789 입니다.", {"name", "phone"}), ("문의 메일: minsu.lee@naver.com 으로 보내주세요", {"email"}), ("우리 반 최수연이 상을 받았다", {"name"}), ("집 주소가 서울시 마포구 양화로 45 3층이에요", {"address"}), ("주민번호 900101-1234567 적어서 냈어요", {"id_number"}),
    ("여권번호는 M12345678 이고 내일 출국합니다", {"id_number"}), ("02-345-6789로 전화했더니 안 받네요", {"phone"}), ("정하늘 님 택배가 도착했습니다", {"name"}), ("제 친구 강민호가 소개해 줬어요", {"name"}), ("부산 해운대구 센텀중앙로 79에서 만나요", {"address"}), ("면허번호 11-22-333333-44 확인 부탁드려요", {"id_number"}), ("이름 : 한지민 / 전화 : 01098765432", {"name", "phone"}),
    ("kim_1990@gmail.com 이랑 seo@daum.net 둘 다 제 거예요", {"email"}), ("계약자는 윤서준이고 보증인은 없습니다", {"name"}), ("대전 유성구 대학로 99 공대 1호관", {"address"}), ("전화주세요 ０１０-５５５５-６６６６", {"phone"}),
]
PLAIN = [
    "사업자등록번호 123-45-67890 입니다", "주문번호 20240101-1234567 조회해 주세요", "어제 김 부장님이 그러셨어요", "서울 가는 기차표 두 장 샀어요", "운송장 612345678901 배송중", "2024-01-05 14:30에 시작합니다", "이벤트는 3월 1일까지예요", "강남역 11번 출구에서 만나", "우리 동네 빵집 최고", "가격은 1,234,567원입니다", "버전 1.2.3.4로 올렸어요", "하늘이 참 맑고 푸르다", "전화번호는 [PHONE] 으로 가렸어요", "한국 대 일본 경기 3:2", "수박 10kg 한 통", "이번 주 로또 번호 3 11 24 35 40 42",
]


def test_personal_data_on_fresh_texts():
    model = pii.fit([])
    texts = [t for t, _ in PERSONAL] + PLAIN
    _, _, spans = pii.spans_of(pa.array(texts), model)
    got = {(int(i), pii.TYPES[int(k)]) for i, _, _, k in spans}
    want = {(i, k) for i, (_, ks) in enumerate(PERSONAL) for k in ks}
    print("types found", len(got & want), "of", len(want), "others taken", sorted((texts[i], k) for i, k in got - want), "missed", sorted((texts[i], k) for i, k in want - got))
    assert len(got & want) >= 13 and len(got - want) <= 1
