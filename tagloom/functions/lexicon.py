"""Labels, token lists and the ordered rule lists, as data.

A rule is a list of conditions that must all hold; the first rule that holds
gives the label.  ``rules.py`` compiles these lists to one ``CASE`` expression,
so another language or label set is a matter of passing other lists.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: the label domain and the fallback labels -----------------

LABEL_PREFIX = "반응_"

INQUIRY = "반응_문의"
EXCHANGE = "반응_교환"
SEEKING = "반응_구해요"
INFO = "반응_정보"
TRADE = "반응_거래"
FINISH_INQUIRY = "반응_마감문의"
SIMPLE = "반응_단순반응"
PRAISE = "반응_제품칭찬"
CRITICISM = "반응_제품비판"
GENERAL = "반응_일반감상"
RECOMMEND = "반응_구매추천"
DISCOURAGE = "반응_구매비추천"

CATEGORIES = (
    INQUIRY, EXCHANGE, SEEKING, INFO, TRADE, FINISH_INQUIRY,
    SIMPLE, PRAISE, CRITICISM, GENERAL, RECOMMEND, DISCOURAGE,
)
WEAK_CATEGORIES = (GENERAL, SIMPLE)
RETIRED_LABEL = "반응_기타"
FINAL_PREFIXES = ("긍정_", "부정_")

# --- fixed values: token lists ----------------------------------------------

TRADE_DONE = ("(완료)", "거래완료", "판매완료", "예약완료")
SIMPLE_REACTION = ("이제 알겠", "왜 가벼워야 하는지", "한번 신겼는데", "기뻐요")
EXCHANGE_WORDS = ("[교환]", "교환원해", "교환 구해", "교환하실", "교환해주", "교환 원해")
SEEKING_WORDS = (
    "[구해요]", "구해요", "구해용", "구합니다", "구입하실분",
    "구해봐", "구해보아요", "구매원해", "구매합니다", "구함",
)
SEEKING_MORE = ("구합", "구해봅", "찾으시는분", "찾아", "찾고")
INFO_WORDS = ("가격", "무배", "할인", "세일", "핫딜", "리셀", "발매", "신상")
INFO_SIGNALS = (
    "품절", "입고", "재입고", "오픈런", "팝업", "팝업스토어", "재고", "공홈", "온라인", "사이트",
)
INQUIRY_SIGNALS = (
    "아시는분", "아시나", "알려", "궁금", "어떤", "어때", "될까", "될까요", "있을까요", "있나요",
    "계신가", "봐주세요", "조언", "팁", "문의", "품번", "사은품", "골라주", "질문", "사이즈",
)
RECOMMEND_YES = ("추천합니다", "추천해", "추천드려", "추천템", "강추", "왕비추천", "잘 샀")
RECOMMEND_NO = ("비추천", "비추", "사지 말", "사지마", "후회", "피하세요", "돈 아깝")
RECOMMEND_ASK = ("다른거추천", "추천부탁", "추천 부탁", "추천해주세요", "추천해주")
INQUIRY_MORE = (
    "온라인", "공홈", "오프라인", "재고있는곳", "품절될까요",
    "구매하신분들", "베이비", "깔창 두개", "살 수 있을까요", "사이트 알려",
)
PRAISE_WORDS = (
    "만족", "좋아요", "좋았", "예쁘", "이쁘", "맘에", "괜찮", "가볍", "최고", "추천후기",
)
CRITICISM_WORDS = (
    "불량", "불편", "실망", "아쉽", "별로", "마감", "문제", "자국", "내구성", "구하기가 힘",
)
BRANDS = ("푸마", "베베드피노", "스피드캣", "에이치스트릿", "몬치치", "h-street")

# --- fixed values: token lists used on model answers only --------------------

ANSWER_DISCOURAGE = ("비추천", "비추", "사지 말", "사지마", "후회", "피하세요")
ANSWER_RECOMMEND = ("추천", "추천해", "추천합", "추천템", "사세요", "잘 샀")
ANSWER_NEGATIVE = (
    "불량", "불편", "실망", "아쉽", "별로", "마감", "문제", "부정_제품", "부정",
)
ANSWER_POSITIVE = (
    "만족", "좋아요", "좋았", "예쁘", "이쁘", "맘에", "괜찮", "가볍", "긍정_제품", "긍정", "후기",
)

# --- fixed values: article text ----------------------------------------------

NOTICE_PHRASES = ("회원간의 거래 분쟁에 대한 공론화 금지",)
PAGE_CHROME = (
    "게시판 목록 바로가기", "본문 바로가기", "웹 접근성이 좋은 모바일 웹", "내소식이 없습니다",
    "가입한 카페의 활동 알림", "카페홈", "가입카페",
)
MAX_SLASHES = 80

# --- fixed values: grid positions and labels ---------------------------------

TARGET_SHEET = "2026 list"
TARGET_MARKER = "반응_제품반응"
TARGET_COLUMN = 7
TITLE_COLUMN = 10
LINK_COLUMN = 11
START_ROW = 5
END_ROW = 220
CARD_ANCHOR = "Voice Of Customer"
CARD_HEADER = "주요 이슈"


# --- the rules ----------------------------------------------------------------


@dataclass(frozen=True)
class AnyOf:
    """The text contains one of the tokens."""

    tokens: tuple[str, ...]
    ignore_case: bool = False


@dataclass(frozen=True)
class StartsWith:
    prefix: str


@dataclass(frozen=True)
class Matches:
    """The text matches ``pattern``; ``needs`` lists tokens one of which any match contains."""

    pattern: str
    needs: tuple[str, ...] = ()


Condition = AnyOf | StartsWith | Matches


@dataclass(frozen=True)
class Rule:
    label: str
    conditions: tuple[Condition, ...]


def _any(label: str, *tokens: str, ignore_case: bool = False) -> Rule:
    return Rule(label, (AnyOf(tokens, ignore_case),))


# (?U): digits, spaces and word boundaries in the Unicode sense.
ARROW = Matches("<->|->|→", needs=("->", "→"))
SIZE_SWAP = Matches(
    r"(?U)\d{2,3}\s*(?:<->|->|→|>|<)\s*\d{2,3}", needs=("→", ">", "<")
)
PRICE = Matches(r"(?U)\b\d[\d,]*원\b", needs=("원",))

TITLE_RULES: tuple[Rule, ...] = (
    _any(TRADE, *TRADE_DONE),
    Rule(FINISH_INQUIRY, (AnyOf(("마감",)), AnyOf(("?",) + INQUIRY_SIGNALS))),
    _any(SIMPLE, *SIMPLE_REACTION),
    Rule(INQUIRY, (StartsWith("[교환]"), ARROW)),
    Rule(INQUIRY, (StartsWith("[구해요]"), AnyOf(("소환",)))),
    _any(INFO, "구매 성공"),
    _any(EXCHANGE, *EXCHANGE_WORDS, ignore_case=True),
    _any(EXCHANGE, "교환", "맞교환"),
    Rule(EXCHANGE, (SIZE_SWAP,)),
    _any(SEEKING, *SEEKING_WORDS, ignore_case=True),
    _any(SEEKING, *SEEKING_MORE),
    _any(DISCOURAGE, *RECOMMEND_NO),
    _any(RECOMMEND, *RECOMMEND_YES),
    _any(INQUIRY, *RECOMMEND_ASK),
    Rule(INQUIRY, (StartsWith("무신사)"),)),
    _any(INQUIRY, *INQUIRY_MORE),
    _any(INQUIRY, "?", *INQUIRY_SIGNALS),
    Rule(INFO, (PRICE,)),
    _any(INFO, *INFO_WORDS, *INFO_SIGNALS, ignore_case=True),
    _any(CRITICISM, *CRITICISM_WORDS),
    _any(INFO, *PRAISE_WORDS),
    _any(INQUIRY, *BRANDS),
)

ANSWER_RULES: tuple[Rule, ...] = (
    _any(TRADE, *TRADE_DONE),
    _any(FINISH_INQUIRY, "마감"),
    _any(DISCOURAGE, *ANSWER_DISCOURAGE),
    _any(RECOMMEND, *ANSWER_RECOMMEND),
    _any(SIMPLE, *SIMPLE_REACTION),
    _any(CRITICISM, *ANSWER_NEGATIVE),
    _any(INFO, *ANSWER_POSITIVE),
)
