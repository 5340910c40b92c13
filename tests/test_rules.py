import pytest
from pyspark.sql import functions as F

from tagloom.functions import lexicon as lx
from tagloom.functions import rules, text

# Bare phrase -> label without prefix; None: no rule holds.
PHRASES = [
    ("[교환] 사이즈 바꿔요", "교환"), ("[교환] 블랙150 -> 140", "문의"), ("[구해요] 130 구해요", "구해요"),
    ("[구해요] 소환합니다", "문의"), ("(완료)몬치치 오버롤 90사이즈", "거래"),
    ("원래 마감이 좀 깔끔치 못한가요?", "마감문의"), ("왜 가벼워야 하는지 이제 알겠네요", "단순반응"),
    ("구매 성공", "정보"), ("150 > 140", "교환"), ("찾고 있어요", "구해요"), ("이건 진짜 비추천", "구매비추천"),
    ("왕비추천", "구매비추천"), ("강추", "구매추천"), ("추천부탁", "문의"), ("무신사) 키즈 79000원 무배", "문의"),
    ("공홈 오픈", "문의"), ("구매처 아시는분", "문의"), ("79,000원 무배", "정보"), ("약79000원", None),
    ("품절풀렸어요", "정보"), ("실망 자국", "제품비판"), ("만족", "정보"), ("h-street", "문의"),
    ("오늘 배송 빠르네요", None),
]
TITLES = [
    ("푸마 에이치스트릿 품절풀렸어요", "정보"), ("캐리마켓 최대 80% 할인 핫딜", "정보"),
    ("캐리마켓 14,310원 핫딜", "정보"), ("무신사) 푸마 키즈 스피드캣 발렛 키즈 79000원 무배", "문의"),
    ("원픽이긴 한데 구매처 아시는분", "문의"), ("[구해요] 150 구해요 79,000원", "구해요"),
    ("(완료)베베드피노 몬치치 오버롤 90사이즈", "거래"), ("베베드피노 원래 마감이 좀 깔끔치 못한가요?", "마감문의"),
    ("가방 왜 가벼워야 하는지 이제 알겠네요..ㅠ", "단순반응"), ("푸마키즈 에이치스트릿 구매 성공👍", "정보"),
    ("푸마 스피드캣 고 구매처 아시는분 ㅜ", "문의"), ("79000원입니다", None), ("마감 임박", "제품비판"),
    ("١٥٠ > ١٤٠", "교환"), ("no korean here", None), ("really?", "문의"), ("H-STREET", None),
]
ANSWERS = [(label, label) for label in lx.CATEGORIES] + [
    ("반응_기타", "반응_단순반응"), ("알 수 없음", "반응_단순반응"), ("", "반응_단순반응"), (None, "반응_단순반응"),
    ("긍정_제품후기", "반응_정보"), ("비추천", "반응_구매비추천"), ("(완료) 거래", "반응_거래"),
    ("마감이 별로인가요", "반응_마감문의"), ("　반응_교환\n", "반응_교환"),
    ("반응_정보 또는 반응_교환", "반응_정보"), ("반응_교환 아니면 반응_기타", "반응_단순반응"),
    ("돈 아깝", "반응_단순반응"), ("추천", "반응_구매추천"), ("부정", "반응_제품비판"),
]


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def labels(spark, values, column):
    return [r.label for r in frame(spark, values).select("i", column.alias("label")).orderBy("i").collect()]


def test_phrases_and_titles(spark):
    cases = PHRASES + TITLES
    got = labels(spark, [c[0] for c in cases], rules.classify_strict(F.col("t")))
    assert got == [None if want is None else lx.LABEL_PREFIX + want for _, want in cases]


def test_general_mode_fills_the_gap(spark):
    values = ["오늘 배송 빠르네요", "", None, " \n", "강추"]
    assert labels(spark, values, rules.classify_general(F.col("t"))) == [lx.SIMPLE] * 4 + [lx.RECOMMEND]


def test_each_token_gives_the_label_of_its_first_rule(spark):
    """Every token alone and inside a sentence, against a plain left-to-right reading of the rules."""
    def plain(rule):
        return len(rule.conditions) == 1 and isinstance(rule.conditions[0], lx.AnyOf) and not rule.conditions[0].ignore_case

    def expected(value):
        for rule in lx.TITLE_RULES:
            if plain(rule) and any(t in value for t in rule.conditions[0].tokens):
                return rule.label
        return None

    tokens = sorted({t for r in lx.TITLE_RULES if plain(r) for t in r.conditions[0].tokens})
    values = [t for t in tokens if "마감" not in t] + [f"가나 {t} 다라" for t in tokens if "마감" not in t]
    values = [v for v in values if not v.startswith("[")]
    assert labels(spark, values, rules.classify_strict(F.col("t"))) == [expected(v) for v in values]


def test_normalise_label(spark):
    got = labels(spark, [a for a, _ in ANSWERS], rules.normalise_label(F.col("t")))
    assert got == [want for _, want in ANSWERS]


def test_normalise_label_is_idempotent(spark):
    once = labels(spark, [a for a, _ in ANSWERS], rules.normalise_label(F.col("t")))
    assert labels(spark, once, rules.normalise_label(F.col("t"))) == once


@pytest.mark.parametrize(
    "raw, want",
    [("제목\n부제목", "제목 부제목"), ("  공백 포함  ", "공백 포함"), ("", None), (None, None), ("　\x1c\x85", None),
     ("a  b\tc", "a b c")],
)
def test_clean_title(spark, raw, want):
    assert labels(spark, [raw], text.clean_title(F.col("t"))) == [want]


def test_final_labels_and_membership(spark):
    values = ["긍정_제품후기", "부정_제품반응", "반응_제품반응", None]
    assert labels(spark, values, text.final_label(F.col("t"))) == [True, True, False, False]
    assert labels(spark, ["반응_문의", "반응_기타", None], rules.is_label(F.col("t"))) == [True, False, False]


def test_needles_leave_out_covered_tokens():
    assert text.distinct_needles(("입고", "재입고", "팝업", "입고")) == ["입고", "팝업"]


def test_rules_run_on_a_stream(spark, tmp_path):
    from tagloom.streaming.titles import label_stream

    source, name = str(tmp_path / "posts"), "labelled_titles"
    spark.createDataFrame([("강추",), ("오늘 배송 빠르네요",)], "title string").write.json(source)
    stream = label_stream(spark.readStream.schema("title string").json(source))
    run = stream.writeStream.format("memory").queryName(name).option(
        "checkpointLocation", str(tmp_path / "state")).start()
    run.processAllAvailable()
    run.stop()
    got = {r.title: r.category for r in spark.table(name).collect()}
    assert got == {"강추": lx.RECOMMEND, "오늘 배송 빠르네요": lx.SIMPLE}


def test_white_space_is_what_python_says(spark):
    import sys

    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert sorted(spaces) == sorted(text.SPACES)
    others = ["​", "᠎", "﻿", "⁠"]
    values = [f"a{s}b" for s in spaces + others] + [f"{s}a{s} {s}b{s}" for s in spaces + others] + ["a  b ", " a b"]
    assert labels(spark, values, text.clean_title(F.col("t"))) == [" ".join(v.split()) for v in values]
    assert labels(spark, values, text.strip(F.col("t"))) == [v.strip() for v in values]
