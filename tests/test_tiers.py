import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import tiers
from tagloom.plans import jobs

GENERAL, SIMPLE, INFO, INQUIRY, TRADE = "반응_일반감상", "반응_단순반응", "반응_정보", "반응_문의", "반응_거래"
ATTEMPT = "text string, attempt int, status string, response string"


def say(label):
    return f'{{"choices":[{{"message":{{"content":"{label}"}}}}]}}'


def scorer(spark, answers, asked=None):
    """Model that knows ``text -> label``; any other text fails three times."""
    known = [(t, 1, "ok", say(label)) for t, label in answers.items()]
    table = spark.createDataFrame(known, ATTEMPT) if known else spark.createDataFrame([], ATTEMPT)

    def score(requests):
        if asked is not None:
            asked.extend(sorted(r.text for r in requests.select("text").collect()))
        return requests.join(table, "text").select("item", "attempt", "status", "response")

    return score


PAGES = {
    "p-rule": "<p>에이치스트릿 재입고 되었어요.</p>", "p-weak": "<p>공지 외 내용 없음</p>", "p-bad": "<p>카페홈</p>",
    "p-a": "<p>본문 A</p>", "p-b": "<p>본문 B</p>",
}
# (title, link, first model, second model) -> category, method; page answers below.
CASES = [
    ("  ", "p-rule", None, None, SIMPLE, "empty"),
    (None, None, None, None, SIMPLE, "empty"),
    ("[교환] 사이즈 교환해요", "p-rule", INFO, None, "반응_교환", "rule"),
    ("애매한 하나", "p-rule", TRADE, None, TRADE, "llm"),
    ("애매한 둘", "p-rule", "반응_기타", None, INFO, "article"),
    ("애매한 셋", "p-rule", None, INQUIRY, INFO, "article"),
    ("애매한 넷", "p-weak", GENERAL, INQUIRY, SIMPLE, "article"),
    ("애매한 다섯", "p-bad", GENERAL, INQUIRY, GENERAL, "article"),
    ("애매한 여섯", None, GENERAL, INQUIRY, GENERAL, "article"),
    ("애매한 일곱", "", None, INQUIRY, INQUIRY, "fallback"),
    ("애매한 여덟", "nowhere", None, None, SIMPLE, "fallback"),
    ("애매한 아홉", "p-a", GENERAL, None, TRADE, "article"),
    ("애매한 열", "p-b", None, TRADE, INQUIRY, "article"),
    ("애매한 열하나", "p-bad", None, GENERAL, GENERAL, "fallback"),
]


@pytest.mark.parametrize("cut", [True, False])
def test_decision_table(spark, cut):
    asked = {k: [] for k in ("title_first", "title_second", "body_first", "body_second")}
    first = {t: a for t, _, a, *_ in CASES if a}
    second = {t: b for t, _, _, b, *_ in CASES if b}
    scorers = tiers.Scorers(
        scorer(spark, first, asked["title_first"]), scorer(spark, second, asked["title_second"]),
        scorer(spark, {"본문 A": TRADE}, asked["body_first"]), scorer(spark, {"본문 B": INQUIRY}, asked["body_second"]),
    )
    rows = [("w", i, c[0], c[1]) for i, c in enumerate(CASES)] + [("v", i, c[0], c[1]) for i, c in enumerate(CASES)]
    targets = spark.createDataFrame(rows, "workbook string, row_num int, title string, link string")
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    options = {} if cut else {"stage": lambda df: df}
    got = tiers.resolve_categories(targets, pages, scorers, **options)
    result = {(r.workbook, r.row_num): (r.category, r.method) for r in got.collect()}
    assert result == {(b, i): (c[4], c[5]) for b in "wv" for i, c in enumerate(CASES)}
    # Each text goes out once, and only where no cheaper tier settled it.
    open_titles = sorted(c[0] for c in CASES[3:])
    assert asked["title_first"] == open_titles
    assert asked["title_second"] == sorted(["애매한 일곱", "애매한 여덟", "애매한 열하나"])
    assert asked["body_first"] == ["공지 외 내용 없음", "본문 A", "본문 B"]
    assert asked["body_second"] == ["공지 외 내용 없음", "본문 B"]


def test_no_request_when_rules_decide(spark):
    asked = []
    one = scorer(spark, {}, asked)
    targets = spark.createDataFrame([("w", 5, "[교환] 140으로 바꿔요", None), ("w", 6, "가격 궁금합니다", None)],
                                    "workbook string, row_num int, title string, link string")
    pages = spark.createDataFrame(list(PAGES.items()), "url string, html string")
    got = tiers.title_categories(targets.drop("link"), pages, tiers.Scorers(one, one, one, one)).collect()
    assert {(r.row_num, r.category) for r in got} == {(5, "반응_교환"), (6, INQUIRY)}
    assert asked == []


def test_attempts(spark):
    rows = [("a", 1, "failed", None), ("a", 2, "ok", "second"), ("a", 3, "ok", "third"), ("b", 1, "failed", None),
            ("b", 4, "ok", "too late"), ("c", 1, "ok", None), ("c", 2, "ok", "later")]
    attempts = spark.createDataFrame(rows, "item string, attempt int, status string, response string")
    got = {r.item: r.response for r in tiers.first_success(attempts, ["item"]).collect()}
    assert got == {"a": "second", "c": None}


def test_recorded_answers(spark):
    attempts = spark.createDataFrame([("애매", 1, "ok", say(INFO))], ATTEMPT).select(
        tiers.item_key(F.col("text")).alias("item"), "attempt", "status", "response")
    requests = spark.createDataFrame([("애매",), ("다른",)], "text string").withColumn("item", tiers.item_key(F.col("text")))
    got = tiers.answers(tiers.recorded(attempts), requests).collect()
    assert [r.label for r in got] == [INFO]


def test_whole_batch(spark):
    cell = "workbook string, sheet_idx int, sheet_name string, row_num int, col_num int, value string, hyperlink string, has_formula boolean"
    rows = [("w", 0, "2026 list", 5, 7, "반응_제품반응", None, False), ("w", 0, "2026 list", 5, 10, "애매한 제목", None, False),
            ("w", 0, "2026 list", 5, 11, "원문", "p-rule", False), ("w", 0, "2026 list", 6, 5, "keep", None, False)]
    for col in (2, 14):
        rows += [("w", 1, "IB", 2, col, "Voice Of Customer", None, False), ("w", 1, "IB", 4, col + 4, "p-rule", None, False),
                 ("w", 1, "IB", 5, col, "주요 이슈", None, False), ("w", 1, "IB", 5, col + 1, "반응_제품반응", None, False)]
    one = scorer(spark, {})
    batch = jobs.classify_grids(
        spark.createDataFrame(rows, cell), spark.createDataFrame(list(PAGES.items()), "url string, html string"),
        tiers.Scorers(one, one, one, one))
    after = {(r.sheet_name, r.row_num, r.col_num): r.value for r in batch.cells.collect()}
    assert after["2026 list", 5, 7] == after["IB", 5, 3] == after["IB", 5, 15] == INFO
    assert after["2026 list", 6, 5] == "keep" and len(after) == len(rows)
    assert {(r.category, r.n) for r in batch.summary.filter("n > 0").collect()} == {(INFO, 1)}
    assert [r.method for r in batch.results.collect()] == ["article"]


def test_each_model_is_called_once_for_all_tables(spark):
    """A random scorer that counts its calls: one for each text, and all tables agree."""
    calls = spark.sparkContext.accumulator(0)
    replies = [say(label) for label in (INFO, TRADE, INQUIRY)]

    def score(requests):
        def answer(frames):
            for frame in frames:
                calls.add(len(frame))
                yield frame[["item"]].assign(attempt=1, status="ok", response=[random.choice(replies) for _ in range(len(frame))])

        return requests.mapInPandas(answer, "item string, attempt int, status string, response string")

    cell = "workbook string, sheet_idx int, sheet_name string, row_num int, col_num int, value string, hyperlink string, has_formula boolean"
    rows = []
    for row in range(5, 27):
        rows += [("w", 0, "2026 list", row, 7, "반응_제품반응", None, False), ("w", 0, "2026 list", row, 10, f"애매한 제목 {row}", None, False)]
    batch = jobs.classify_grids(
        spark.createDataFrame(rows, cell), spark.createDataFrame(list(PAGES.items()), "url string, html string"),
        tiers.Scorers(score, score, score, score))
    results = {r.row_num: r.category for r in batch.results.collect()}
    assert {r.row_num: r.value for r in batch.updates.collect()} == results
    assert {r.row_num: r.value for r in batch.cells.filter("col_num = 7").collect()} == results
    counts = {r.category: r.n for r in batch.summary.filter("n > 0").collect()}
    assert counts == {c: list(results.values()).count(c) for c in set(results.values())}
    assert calls.value == 22


def test_answers_are_kept_across_runs(spark, tmp_path):
    requests = lambda *texts: spark.createDataFrame([(t,) for t in texts], "text string").select(tiers.item_key(F.col("text")).alias("item"), "text")
    asked = []
    model = tiers.remembered(scorer(spark, {"a": TRADE, "b": INFO, "c": INQUIRY}, asked), str(tmp_path / "answers"))
    labels = lambda frame: {r.item: r.label for r in tiers.answers(model, frame).collect()}
    first = labels(requests("a", "b", "unknown"))
    assert sorted(first.values()) == sorted([TRADE, INFO]) and asked == ["a", "b", "unknown"]
    asked.clear()
    grown = labels(requests("a", "b", "c", "unknown"))
    assert sorted(grown.values()) == sorted([TRADE, INFO, INQUIRY]) and asked == ["c", "unknown"]
    asked.clear()
    assert labels(requests("a")) == {k: v for k, v in first.items() if v == TRADE} and asked == []
    (tmp_path / "answers" / "call-lost").mkdir()  # a call that never ended
    assert labels(requests("a", "c")) == {k: v for k, v in grown.items() if v != INFO}


def test_a_second_run_of_the_tiers_asks_for_new_texts_only(spark, tmp_path):
    asked = []
    known = scorer(spark, {"애매한 하나": TRADE, "애매한 둘": INFO, "애매한 셋": INQUIRY}, asked)
    silent = scorer(spark, {})
    kept = {n: tiers.remembered(m, str(tmp_path / n)) for n, m in {"a": known, "b": silent, "c": silent, "d": silent}.items()}
    scorers = tiers.Scorers(kept["a"], kept["b"], kept["c"], kept["d"])
    pages = spark.createDataFrame([], "url string, html string")

    def run(titles):
        rows = spark.createDataFrame([("w", i, t, None) for i, t in enumerate(titles)], "workbook string, row_num int, title string, link string")
        return {r.row_num: r.category for r in tiers.resolve_categories(rows, pages, scorers).collect()}

    assert run(["애매한 하나", "애매한 둘"]) == {0: TRADE, 1: INFO} and asked == sorted(["애매한 둘", "애매한 하나"])
    asked.clear()
    assert run(["애매한 하나", "애매한 둘", "애매한 셋", "애매한 하나"]) == {0: TRADE, 1: INFO, 2: INQUIRY, 3: TRADE} and asked == ["애매한 셋"]
