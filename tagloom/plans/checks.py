"""The same results in ANSI SQL, written from the operators' definitions.

Token lists and conditions are spelled out here on their own, so that a slip in
the lexicon shows as a difference.
"""

from __future__ import annotations

from tagloom.functions.prompts import BODY_PROMPT, TITLE_PROMPT
from tagloom.plans.views import with_clause

CHECKS: dict[str, str] = {}

SPACE = r"[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]"
LABELS = [
    "반응_문의", "반응_교환", "반응_구해요", "반응_정보", "반응_거래", "반응_마감문의",
    "반응_단순반응", "반응_제품칭찬", "반응_제품비판", "반응_일반감상", "반응_구매추천", "반응_구매비추천",
]
LABEL_LIST = ", ".join(f"'{label}'" for label in LABELS)


def check(name: str, views: list[str], sql: str) -> None:
    CHECKS[name] = f"{with_clause(views)}\n{sql}" if views else sql


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def has(x: str, *tokens: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {quoted(t)})" for t in tokens) + ")"


def clean(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{SPACE}+', ' ', 'g')), '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


INQUIRY = (
    "아시는분", "아시나", "알려", "궁금", "어떤", "어때", "될까", "될까요", "있을까요", "있나요",
    "계신가", "봐주세요", "조언", "팁", "문의", "품번", "사은품", "골라주", "질문", "사이즈",
)


def rules(x: str) -> str:
    """Title rules on a cleaned text column; NULL when none holds."""
    return f"""CASE WHEN {x} IS NULL THEN NULL
 WHEN {has(x, '(완료)', '거래완료', '판매완료', '예약완료')} THEN '반응_거래'
 WHEN {has(x, '마감')} AND {has(x, '?', *INQUIRY)} THEN '반응_마감문의'
 WHEN {has(x, '이제 알겠', '왜 가벼워야 하는지', '한번 신겼는데', '기뻐요')} THEN '반응_단순반응'
 WHEN starts_with({x}, '[교환]') AND {has(x, '<->', '->', '→')} THEN '반응_문의'
 WHEN starts_with({x}, '[구해요]') AND {has(x, '소환')} THEN '반응_문의'
 WHEN {has(x, '구매 성공')} THEN '반응_정보'
 WHEN {has(f'lower({x})', '[교환]', '교환원해', '교환 구해', '교환하실', '교환해주', '교환 원해')} THEN '반응_교환'
 WHEN {has(x, '교환', '맞교환')} THEN '반응_교환'
 WHEN regexp_matches({x}, '[0-9]{{2,3}}\\s*(<->|->|→|>|<)\\s*[0-9]{{2,3}}') THEN '반응_교환'
 WHEN {has(f'lower({x})', '[구해요]', '구해요', '구해용', '구합니다', '구입하실분', '구해봐', '구해보아요',
           '구매원해', '구매합니다', '구함')} THEN '반응_구해요'
 WHEN {has(x, '구합', '구해봅', '찾으시는분', '찾아', '찾고')} THEN '반응_구해요'
 WHEN {has(x, '비추천', '비추', '사지 말', '사지마', '후회', '피하세요', '돈 아깝')} THEN '반응_구매비추천'
 WHEN {has(x, '추천합니다', '추천해', '추천드려', '추천템', '강추', '왕비추천', '잘 샀')} THEN '반응_구매추천'
 WHEN {has(x, '다른거추천', '추천부탁', '추천 부탁', '추천해주세요', '추천해주')} THEN '반응_문의'
 WHEN starts_with({x}, '무신사)') THEN '반응_문의'
 WHEN {has(x, '온라인', '공홈', '오프라인', '재고있는곳', '품절될까요', '구매하신분들', '베이비', '깔창 두개',
           '살 수 있을까요', '사이트 알려')} THEN '반응_문의'
 WHEN {has(x, '?', *INQUIRY)} THEN '반응_문의'
 WHEN regexp_matches({x}, '(^|[^0-9A-Za-z_가-힣])[0-9][0-9,]*원($|[^0-9A-Za-z_가-힣])') THEN '반응_정보'
 WHEN {has(f'lower({x})', '가격', '무배', '할인', '세일', '핫딜', '리셀', '발매', '신상', '품절', '입고', '재입고',
           '오픈런', '팝업', '팝업스토어', '재고', '공홈', '온라인', '사이트')} THEN '반응_정보'
 WHEN {has(x, '불량', '불편', '실망', '아쉽', '별로', '마감', '문제', '자국', '내구성', '구하기가 힘')} THEN '반응_제품비판'
 WHEN {has(x, '만족', '좋아요', '좋았', '예쁘', '이쁘', '맘에', '괜찮', '가볍', '최고', '추천후기')} THEN '반응_정보'
 WHEN {has(x, '푸마', '베베드피노', '스피드캣', '에이치스트릿', '몬치치', 'h-street')} THEN '반응_문의'
 END"""


def normalised(x: str) -> str:
    """Model answer (already stripped, never NULL) to a domain label."""
    places = ", ".join(
        f"CASE WHEN contains({x}, '{label}') THEN {{'at': strpos({x}, '{label}'), 'label': '{label}'}} END"
        for label in LABELS
    )
    return f"""CASE WHEN {x} IN ({LABEL_LIST}) THEN {x}
 WHEN {x} = '' OR contains({x}, '반응_기타') THEN '반응_단순반응'
 WHEN {has(x, *LABELS)} THEN list_min([{places}]).label
 WHEN {has(x, '(완료)', '거래완료', '판매완료', '예약완료')} THEN '반응_거래'
 WHEN {has(x, '마감')} THEN '반응_마감문의'
 WHEN {has(x, '비추천', '비추', '사지 말', '사지마', '후회', '피하세요')} THEN '반응_구매비추천'
 WHEN {has(x, '추천', '추천해', '추천합', '추천템', '사세요', '잘 샀')} THEN '반응_구매추천'
 WHEN {has(x, '이제 알겠', '왜 가벼워야 하는지', '한번 신겼는데', '기뻐요')} THEN '반응_단순반응'
 WHEN {has(x, '불량', '불편', '실망', '아쉽', '별로', '마감', '문제', '부정_제품', '부정')} THEN '반응_제품비판'
 WHEN {has(x, '만족', '좋아요', '좋았', '예쁘', '이쁘', '맘에', '괜찮', '가볍', '긍정_제품', '긍정', '후기')} THEN '반응_정보'
 ELSE '반응_단순반응' END"""


def letters(n: str) -> str:
    """Column letters of a number below 475,255."""
    return (
        f"concat(CASE WHEN {n} > 18278 THEN chr(CAST(65 + ({n} - 18279) // 17576 AS INT)) ELSE '' END, "
        f"CASE WHEN {n} > 702 THEN chr(CAST(65 + (({n} - 703) // 676) % 26 AS INT)) ELSE '' END, "
        f"CASE WHEN {n} > 26 THEN chr(CAST(65 + (({n} - 27) // 26) % 26 AS INT)) ELSE '' END, "
        f"chr(CAST(65 + ({n} - 1) % 26 AS INT)))"
    )


def shifted(c: str) -> str:
    return f"CAST(CASE WHEN {c} < 2 THEN {c} ELSE {c} + ({c} - 2) // 6 END AS INT)"


# --- pieces shared by several checks ---------------------------------------------------

TEXTS = "texts AS (SELECT d.doc_id, concat(p.phrase, ' ', d.text) AS text FROM documents d JOIN phrases p ON d.doc_id % 30 = p.i)"
TARGETS = f"""targets AS (SELECT * FROM (
  SELECT workbook, row_num, {clean('title')} AS title,
         CASE WHEN doc_id % 2 = 0 THEN coalesce(nullif(coalesce(link, 'https://example.com/none'), ''), '원문')
              ELSE nullif(link, '') END AS link
  FROM post_list WHERE row_num >= 5 AND row_num <= 220 AND marker = '반응_제품반응') WHERE title IS NOT NULL)"""
RESULTS = f"{TARGETS}, results AS (SELECT workbook, row_num, link, coalesce({rules('title')}, '반응_단순반응') AS category FROM targets)"
GOOD_CARDS = "anchor = 'Voice Of Customer' AND header = '주요 이슈' AND coalesce(link, '') <> ''"
INDEX = f"""card_index AS (SELECT workbook, link, sheet_idx, sheet_name, 5 AS row_num, card_start + 1 AS col_num
  FROM cards WHERE {GOOD_CARDS} AND NOT starts_with(category, '긍정_') AND NOT starts_with(category, '부정_'))"""
ALL_CARDS = f"""all_cards AS (SELECT workbook, sheet_idx, sheet_name, card_start + 1 AS col_num,
  concat({letters('(card_start + 1)')}, '5') AS cell_ref FROM cards WHERE {GOOD_CARDS})"""
FANNED = f"""{INDEX}, updates AS (
  SELECT workbook, CAST(NULL AS INT) AS sheet_idx, '2026 list' AS sheet_name, row_num, 7 AS col_num, category AS value, row_num AS target_row, 0 AS branch FROM results
  UNION ALL
  SELECT r.workbook, c.sheet_idx, c.sheet_name, c.row_num, c.col_num, r.category, r.row_num, 1
  FROM results r JOIN card_index c ON r.workbook = c.workbook AND r.link = c.link)"""
UPDATES = f"{RESULTS}, {FANNED}"
LAST = """winners AS (SELECT workbook, sheet_idx, sheet_name, row_num, col_num, value FROM (
  SELECT *, row_number() OVER (PARTITION BY workbook, sheet_name, row_num, col_num ORDER BY target_row DESC, branch DESC) AS rn
  FROM updates) WHERE rn = 1)"""
WINNERS = f"{UPDATES}, {LAST}"
UPSERT = """SELECT coalesce(c.workbook, w.workbook) AS workbook, coalesce(c.sheet_name, w.sheet_name) AS sheet_name,
 coalesce(c.row_num, w.row_num) AS row_num, coalesce(c.col_num, w.col_num) AS col_num,
 CASE WHEN c.has_formula THEN c.value WHEN w.value IS NOT NULL THEN w.value ELSE c.value END AS value, coalesce(c.has_formula, false) AS has_formula
FROM cells c FULL JOIN winners w ON c.workbook = w.workbook AND c.sheet_name = w.sheet_name AND c.row_num = w.row_num AND c.col_num = w.col_num"""
MAX_COLS = "max_cols AS (SELECT workbook, sheet_name, greatest(1, max(col_num)) AS max_col FROM cells GROUP BY ALL)"
SUMMARY = """SELECT b.workbook, c.category, count(r.category) AS n
FROM (SELECT DISTINCT workbook FROM {t}) b, (SELECT unnest([{labels}]) AS category) c
LEFT JOIN {t} r ON r.workbook = b.workbook AND r.category = c.category GROUP BY b.workbook, c.category"""


def rest(name: str, views: list[str], ctes: str, sql: str) -> None:
    """A check with more common table expressions behind the views."""
    CHECKS[name] = f"{with_clause(views)},\n{ctes}\n{sql}"


def summary(table: str) -> str:
    return SUMMARY.format(t=table, labels=LABEL_LIST)


# --- scans ---------------------------------------------------------------------------------

SLOT = "(doc_id % 40)"
NUMBERED = "books AS (SELECT DISTINCT workbook, CAST(substr(workbook, 3) AS INT) AS n FROM sheets)"
rest("s1_unreadable_parts", ["sheets"], NUMBERED, """SELECT workbook, 'xl/workbook.xml' AS part, 'not well-formed' AS reason FROM books WHERE n % 5 = 1
UNION ALL SELECT workbook, 'xl/sharedStrings.xml', 'not well-formed' FROM books WHERE n % 5 = 2
UNION ALL SELECT workbook, 'xl/worksheets/sheet1.xml', 'member cannot be read' FROM books WHERE n % 5 = 3""")
check("s2_sheet_catalogue", ["sheets"], "SELECT workbook, CAST(row_number() OVER (PARTITION BY workbook ORDER BY sheet_idx) - 1 AS INT) AS sheet_idx, sheet_name, state, part FROM sheets")
check("s3_shared_strings", ["post_list"], f"SELECT workbook, CAST({SLOT} AS INT) AS idx, title AS text FROM post_list")
FIRST_SHEET = "posts AS (SELECT p.*, s.sheet_name FROM post_list p JOIN sheets s ON p.workbook = s.workbook WHERE s.part = 'xl/worksheets/sheet1.xml')"
rest("s4_cell_scan", ["post_list", "sheets"], FIRST_SHEET, f"""
SELECT workbook, sheet_name, row_num, 7 AS col_num, marker AS value, 'inlineStr' AS cell_type, false AS has_formula FROM posts
UNION ALL SELECT workbook, sheet_name, row_num, 8, '2', NULL, true FROM posts WHERE {SLOT} % 6 = 2
UNION ALL SELECT workbook, sheet_name, row_num, 10, title, 's', false FROM posts WHERE {SLOT} % 13 <> 7
UNION ALL SELECT workbook, sheet_name, row_num, 11, link, 'str', false FROM posts WHERE link <> ''""")
rest("s5_hyperlinks", ["post_list", "sheets"], FIRST_SHEET,
     "SELECT workbook, sheet_name, concat('K', row_num) AS cell_ref, link AS hyperlink FROM posts WHERE link <> ''")
check("s6_defined_names", ["cells"], """SELECT DISTINCT workbook, 'Total' AS name, NULL AS local_sheet_id, 'SUM(A:A)' AS text FROM cells
UNION ALL SELECT DISTINCT workbook, '_xlnm.Print_Area', 1, 'S0!$B$2' FROM cells""")
rest("s7_merge_ranges", ["post_list", "sheets"], "refs AS (SELECT workbook, concat('A', row_num, ':B', row_num) AS r FROM post_list WHERE doc_id % 40 % 3 = 0)",
     """SELECT s.workbook, s.sheet_name, string_agg(r.r, ',' ORDER BY r.r) AS merges FROM sheets s JOIN refs r ON s.workbook = r.workbook
WHERE s.part = 'xl/worksheets/sheet1.xml' GROUP BY s.workbook, s.sheet_name""")
check("s8_link_text", ["cells"], """SELECT workbook, sheet_name, row_num, col_num,
 CASE WHEN coalesce(hyperlink, '') <> '' THEN hyperlink WHEN value <> '' THEN value END AS link
FROM cells WHERE (sheet_name = '2026 list' AND col_num = 11) OR (sheet_name <> '2026 list' AND row_num = 4)""")
check("s9_single_input", ["input_listing"], "SELECT folder, min(path) AS path FROM input_listing GROUP BY folder HAVING count(*) = 1")
check("s10_newest_artifact", ["listing_before"], "SELECT folder, path, modified FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY modified DESC, path DESC) AS rn FROM listing_before) WHERE rn = 1")
rest("s12_article_source", ["post_list", "article_pages"], TARGETS,
     "SELECT t.workbook, t.row_num, t.link, p.page_id, sha256(p.html) AS html_sha256 FROM targets t LEFT JOIN article_pages p ON t.link = p.url")
check("s13_charset_cascade", ["phrases"], r"""SELECT d.doc_id, CAST(w.way AS INT) AS way, CASE WHEN w.way >= 3
 THEN concat(p.phrase, ' ', regexp_replace(coalesce(d.text, ''), '[^\x00-\x7F]', '?', 'g')) ELSE nullif(d.text, '') END AS text
FROM documents d JOIN phrases p ON d.doc_id % 30 = p.i, (SELECT unnest(range(0, 6)) AS way) w""")
SAFE = f"({strip('kind')} <> '' AND {strip('kind')} NOT IN ('.', '..') AND NOT contains(kind, '/') AND NOT contains(kind, chr(92)))"
check("s14_dated_output", ["output_names"], f"SELECT o_orderkey, CASE WHEN {SAFE} THEN concat('output/', strftime(o_orderdate, '%y%m%d'), '_', {strip('kind')}, '_', name) END AS path FROM output_names")
check("s15_qa_output", ["output_names"], f"SELECT o_orderkey, CASE WHEN {SAFE} THEN concat('output/qa/', {strip('kind')}, '/', name) END AS path FROM output_names")

# --- projections and filters -------------------------------------------------------------------

rest("p1_target_rows", ["post_list"], TARGETS, "SELECT * FROM targets")
check("p1_target_rows_wide", ["post_list"], f"""SELECT * FROM (SELECT workbook, row_num, {clean('title')} AS title, nullif(link, '') AS link
FROM post_list WHERE row_num BETWEEN 5 AND 220 AND marker = '반응_제품반응') WHERE title IS NOT NULL""")
rest("p2_target_count", ["post_list"], TARGETS, "SELECT workbook, count(*) AS n_targets FROM targets GROUP BY workbook")
rest("p3_clean_title", ["phrases"], TEXTS, f"SELECT doc_id, {clean('text')} AS title FROM texts")
check("p4_skip_final", ["cells"], "SELECT workbook, sheet_name, row_num, col_num, value FROM cells WHERE NOT coalesce(starts_with(value, '긍정_') OR starts_with(value, '부정_'), false)")
check("p5_label_membership", ["model_answers"], f"SELECT doc_id, coalesce(answer IN ({LABEL_LIST}), false) AS is_label FROM model_answers")
check("p6_ref_encode", [], f"SELECT l_orderkey, l_linenumber, l_partkey, concat({letters('l_partkey')}, l_linenumber) AS cell_ref FROM lineitem")
check("p6_ref_decode", ["cells"], f"SELECT workbook, sheet_name, concat({letters('col_num')}, row_num) AS cell_ref, row_num, col_num FROM cells")
STRIPPED = f"answered AS (SELECT doc_id, coalesce({strip('answer')}, '') AS v FROM model_answers)"
rest("p7_weak_labels", ["model_answers"], STRIPPED, f"SELECT * FROM (SELECT doc_id, {normalised('v')} AS label FROM answered) WHERE label IN ('반응_일반감상', '반응_단순반응')")

# --- classification ------------------------------------------------------------------------------

CLEANED = f"{TEXTS}, cleaned AS (SELECT doc_id, {clean('text')} AS t FROM texts)"
rest("k1_rule_cascade_strict", ["phrases"], CLEANED, f"SELECT doc_id, {rules('t')} AS label FROM cleaned")
check("k1_rules_on_documents", [], f"SELECT doc_id, {rules('t')} AS label FROM (SELECT doc_id, {clean('text')} AS t FROM documents)")
rest("k2_rule_cascade_general", ["phrases"], CLEANED, f"SELECT doc_id, coalesce({rules('t')}, '반응_단순반응') AS label FROM cleaned")
check("k3_title_rules", ["post_list"], f"SELECT workbook, row_num, {rules('t')} AS label FROM (SELECT workbook, row_num, {clean('title')} AS t FROM post_list)")
rest("k4_normalise_label", ["model_answers"], STRIPPED, f"SELECT doc_id, {normalised('v')} AS label FROM answered")
rest("k5_title_prompt", ["post_list"], TARGETS, f"SELECT workbook, row_num, sha256(concat({quoted(TITLE_PROMPT)}, title)) AS prompt_sha256 FROM targets")
check("k6_body_prompt", [], f"SELECT doc_id, sha256(concat({quoted(BODY_PROMPT)}, text)) AS prompt_sha256 FROM documents")
check("k7_request_body", [], f"""SELECT doc_id, 'openai/gpt-4o' AS model, 'system' AS first_role, sha256(concat({quoted(BODY_PROMPT)}, text)) AS prompt_sha256,
 'user' AS second_role, text AS user_text FROM documents""")
CONTENT = f"""content AS (SELECT *, json_extract(try_cast(response AS JSON), '$.choices[0].message.content') AS c FROM attempts),
said AS (SELECT *, c IS NULL AS malformed,
 coalesce({strip("CASE WHEN json_type(c) <> 'NULL' THEN json_extract_string(c, '$') END")}, '') AS v FROM content),
judged AS (SELECT item, model, attempt, status, CASE WHEN malformed THEN '반응_일반감상' ELSE {normalised('v')} END AS label FROM said)"""
rest("k8_response_label", ["attempts"], CONTENT, "SELECT item, model, attempt, label FROM judged")
check("k9_first_success", ["attempts"], """SELECT item, model, response FROM (SELECT *, row_number() OVER (PARTITION BY item, model ORDER BY attempt) AS rn
FROM attempts WHERE status = 'ok' AND attempt BETWEEN 1 AND 3) WHERE rn = 1""")
ARTICLES = f"""inner_html AS (SELECT page_id, url,
 CASE WHEN regexp_matches(html, '<section[^>]*class=') THEN regexp_extract(html, '(?is)<section[^>]*class=["''][^"'']*["''][^>]*>(.*?)</section>', 1) ELSE html END AS h FROM article_pages),
no_script AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\\b[^>]*>.*?</script>', ' ', 'g'),
 '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g'), '(?is)<noscript\\b[^>]*>.*?</noscript>', ' ', 'g') AS h FROM inner_html),
no_notice AS (SELECT page_id, url, replace(regexp_replace(h, '<[^>]+>[^<]*회원간의 거래 분쟁에 대한 공론화 금지[^<]*</[^>]+>', ' ', 'g'),
 '회원간의 거래 분쟁에 대한 공론화 금지', ' ') AS h FROM no_script),
lined AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(replace(regexp_replace(h, '<[^>]+>', chr(10), 'g'),
 '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS t FROM no_notice),
squeezed AS (SELECT page_id, url, nullif({strip("regexp_replace(regexp_replace(t, '\\n+', chr(10), 'g'), '[ \\t]+', ' ', 'g')")}, '') AS t FROM lined),
articles AS (SELECT page_id, url, CASE WHEN length(t) - length(replace(t, '/', '')) > 80
 OR {has('t', '게시판 목록 바로가기', '본문 바로가기', '웹 접근성이 좋은 모바일 웹', '내소식이 없습니다', '가입한 카페의 활동 알림', '카페홈', '가입카페')}
 THEN NULL ELSE t END AS article_text FROM squeezed)"""
rest("k10_article_text", ["article_pages"], ARTICLES, "SELECT page_id, article_text FROM articles")


def call(text: str, shift: int) -> str:
    return f"(length({text}) * 7 + length(replace({text}, ' ', '')) * 13 + {shift}) % (SELECT max(item) + 1 FROM attempts)"


SETTLED = f"""{CONTENT}, settled AS (SELECT item, model, label FROM (SELECT *, row_number() OVER (PARTITION BY item, model ORDER BY attempt) AS rn
 FROM judged WHERE status = 'ok' AND attempt BETWEEN 1 AND 3) WHERE rn = 1)"""
BODIES = f"""{ARTICLES}, {SETTLED},
ruled_body AS (SELECT page_id, url, article_text, {rules('t')} AS rule FROM (SELECT *, {clean('article_text')} AS t FROM articles WHERE article_text IS NOT NULL)),
body AS (SELECT r.page_id, r.url, coalesce(r.rule, a.label, b.label, '반응_단순반응') AS article FROM ruled_body r
 LEFT JOIN settled a ON a.model = 'A' AND a.item = {call('r.article_text', 1)}
 LEFT JOIN settled b ON b.model = 'B' AND b.item = {call('r.article_text', 1)})"""
rest("k11_body_tier", ["article_pages", "attempts"], BODIES, "SELECT page_id, article FROM body")
rest("k12_article_tier", ["post_list", "article_pages", "attempts"], f"{TARGETS}, {BODIES}",
     "SELECT t.workbook, t.row_num, b.article FROM targets t LEFT JOIN body b ON t.link = b.url")


def resolved(source: str, link: str) -> str:
    """Tier resolution of rows (workbook, row_num, title, link)."""
    return f"""{BODIES},
base AS (SELECT workbook, row_num, {clean('title')} AS title, nullif({link}, '') AS link FROM {source}),
ruled AS (SELECT *, {rules('title')} AS rule FROM base),
tiered AS (SELECT r.*, a.label AS first, b.label AS second, d.article FROM ruled r
 LEFT JOIN settled a ON a.model = 'A' AND a.item = {call('r.title', 0)}
 LEFT JOIN settled b ON b.model = 'B' AND b.item = {call('r.title', 0)}
 LEFT JOIN body d ON d.url = r.link),
resolved AS (SELECT workbook, row_num,
 CASE WHEN title IS NULL THEN '반응_단순반응' WHEN rule IS NOT NULL THEN rule
      WHEN first NOT IN ('반응_일반감상', '반응_단순반응') THEN first
      WHEN article IS NOT NULL THEN article WHEN first IS NOT NULL THEN first
      WHEN second IS NOT NULL THEN second ELSE '반응_단순반응' END AS category,
 CASE WHEN title IS NULL THEN 'empty' WHEN rule IS NOT NULL THEN 'rule'
      WHEN first NOT IN ('반응_일반감상', '반응_단순반응') THEN 'llm'
      WHEN article IS NOT NULL OR first IS NOT NULL THEN 'article' ELSE 'fallback' END AS method FROM tiered)"""


TIERS = ["post_list", "article_pages", "attempts"]
rest("k13_tier_resolver", TIERS, resolved("post_list", "link"), "SELECT * FROM resolved")
rest("k14_title_only", TIERS, resolved("post_list", "''"), "SELECT workbook, row_num, category FROM resolved")
rest("k15_batch_summary", TIERS, f"{TARGETS}, {resolved('targets', 'link')}", summary("resolved"))

rest("k15_batch_grid", TIERS + ["cards", "cells"], f"""{TARGETS}, {resolved('targets', 'link')},
results AS (SELECT t.workbook, t.row_num, t.link, r.category FROM targets t JOIN resolved r ON t.workbook = r.workbook AND t.row_num = r.row_num),
{FANNED}, {LAST}""", UPSERT)

# --- joins -------------------------------------------------------------------------------------------

rest("j1_card_index", ["cards"], INDEX, "SELECT workbook, link, sheet_name, row_num, col_num FROM card_index")
rest("j2_card_targets", ["cards", "sheets", "workbooks"], f"""own_cards AS (SELECT c.workbook, c.sheet_name,
 card_start + CASE WHEN w.family = 'f1' THEN 2 ELSE 1 END AS col_num FROM cards c JOIN workbooks w ON w.workbook = c.workbook
 WHERE {GOOD_CARDS} AND w.family IN ('f0', 'f1'))""", f"""SELECT c.workbook, c.sheet_name, string_agg(concat({letters('c.col_num')}, '5'), ',' ORDER BY c.col_num) AS refs
FROM own_cards c JOIN sheets s ON c.workbook = s.workbook AND c.sheet_name = s.sheet_name GROUP BY c.workbook, c.sheet_name""")
GRID = ["post_list", "cards", "cells"]
rest("j3_fan_out", GRID, UPDATES, "SELECT workbook, sheet_name, row_num, col_num, value, target_row FROM updates")
rest("j4_upsert", GRID, WINNERS, UPSERT.replace("SELECT ", "SELECT coalesce(c.sheet_idx, w.sheet_idx) AS sheet_idx, ", 1))
SURFACE = f"""{ALL_CARDS}, surface AS (SELECT workbook, sheet_name, cell_ref FROM all_cards
 UNION SELECT workbook, '2026 list', concat('G', r) FROM (SELECT DISTINCT workbook FROM cells), (SELECT unnest(range(5, 221)) AS r))"""
VIOLATIONS = f"""{SURFACE}, written AS (SELECT workbook, sheet_name, cell_ref, min(seq) AS seq FROM writes GROUP BY ALL),
violations AS (SELECT w.*, CASE WHEN k.sheet_name IS NULL THEN 'unsupported_write_sheet' ELSE 'unsupported_write_cell' END AS code,
 CASE WHEN k.sheet_name IS NULL THEN concat('write targets unsupported sheet ', w.sheet_name)
      ELSE concat('write targets unsupported cell ', w.sheet_name, '!', w.cell_ref) END AS detail
 FROM written w LEFT JOIN (SELECT DISTINCT workbook, sheet_name FROM surface) k ON k.workbook = w.workbook AND k.sheet_name = w.sheet_name
 WHERE (w.workbook, w.sheet_name, w.cell_ref) NOT IN (SELECT workbook, sheet_name, cell_ref FROM surface))"""
FIRST_VIOLATION = "first_violation AS (SELECT workbook, arg_min(code, seq) AS code, arg_min(detail, seq) AS detail FROM violations GROUP BY workbook)"
rest("j5_surface_violations", ["cards", "cells", "writes"], VIOLATIONS, "SELECT workbook, sheet_name, cell_ref, code, detail FROM violations")
PARTS = ["parts_left", "parts_right"]
CHANGES = """changes AS (SELECT coalesce(l.workbook, r.workbook) AS workbook, coalesce(l.part, r.part) AS part,
 CASE WHEN l.part IS NULL THEN 'added' WHEN r.part IS NULL THEN 'removed' WHEN l.sha256 <> r.sha256 THEN 'changed' ELSE 'equal' END AS status
 FROM parts_left l FULL JOIN parts_right r ON l.workbook = r.workbook AND l.part = r.part)"""
rest("j6_part_changes", PARTS, CHANGES, "SELECT * FROM changes")
rest("j7_untouched_cells", GRID, WINNERS, """SELECT workbook, sheet_name, row_num, col_num, value FROM cells c
WHERE NOT EXISTS (SELECT 1 FROM winners w WHERE w.workbook = c.workbook AND w.sheet_name = c.sheet_name AND w.row_num = c.row_num AND w.col_num = c.col_num)""")
check("j8_sheet_parts", ["sheets"], "SELECT workbook, part FROM sheets WHERE state = 'hidden'")

# --- aggregates -------------------------------------------------------------------------------------------

rest("a1_category_summary", ["post_list"], RESULTS, summary("results"))
rest("a2_method_counts", TIERS, f"{TARGETS}, {resolved('targets', 'link')}", "SELECT workbook, method, count(*) AS n FROM resolved GROUP BY ALL")
rest("a3_card_positions", ["cards"], INDEX, f"""SELECT workbook, link, string_agg(concat(sheet_name, '!', {letters('col_num')}, row_num), ',' ORDER BY sheet_idx, col_num) AS positions
FROM card_index GROUP BY workbook, link""")
rest("a4_updates_by_sheet", GRID, WINNERS, f"""SELECT workbook, sheet_name, string_agg(e, ',' ORDER BY e) AS cells
FROM (SELECT workbook, sheet_name, concat({letters('col_num')}, row_num, '=', value) AS e FROM winners) GROUP BY workbook, sheet_name""")
check("a5_object_counts", ["parts_left"], """SELECT workbook, count(*) FILTER (part LIKE 'xl/media/%') AS media_count,
 count(*) FILTER (part LIKE 'xl/drawings/%') AS drawing_count FROM parts_left GROUP BY workbook""")
rest("a6_max_column", ["cells", "sheets"], MAX_COLS, """SELECT coalesce(m.workbook, s.workbook) AS workbook, coalesce(m.sheet_name, s.sheet_name) AS sheet_name,
 CASE WHEN s.workbook IS NOT NULL THEN 52 ELSE m.max_col END AS max_col
FROM max_cols m FULL JOIN (SELECT * FROM sheets WHERE sheet_idx % 4 = 1) s ON m.workbook = s.workbook AND m.sheet_name = s.sheet_name""")
STATES = "string_agg(concat(sheet_name, '=', state), ',' ORDER BY sheet_name)"
check("a7_fingerprint", ["sheets", "workbooks"], f"""SELECT w.workbook, w.file_sha256, w.workbook_xml_sha256,
 string_agg(sheet_name, ',' ORDER BY sheet_idx) AS sheet_order, CASE WHEN count(sheet_name) > 0 THEN {STATES} END AS sheet_states
FROM workbooks w LEFT JOIN sheets s ON w.workbook = s.workbook GROUP BY w.workbook, w.file_sha256, w.workbook_xml_sha256""")
METRICS = ["load_seconds", "manifest_build_seconds", "classify_seconds", "write_seconds", "save_seconds", "output_stage_seconds", "total_seconds"]


def middle(metric: str) -> str:
    """Mean of the two middle values of a sorted list (the same one twice when odd)."""
    v = f"list_sort(list({metric}))"
    return f"({v}[(count(*) + 1) // 2] + {v}[count(*) // 2 + 1]) / 2 AS {metric}"


MEDIANS = f"""medians AS (SELECT writer, {', '.join(middle(m) for m in METRICS)}
 FROM (SELECT *, write_seconds + save_seconds AS output_stage_seconds FROM bench_runs) GROUP BY writer)"""
COMPARED = f"""{MEDIANS}, both_writers AS (SELECT p.output_stage_seconds AS c, l.output_stage_seconds AS b
 FROM medians p JOIN medians l ON p.writer = 'primary' AND l.writer = 'legacy')"""
rest("a8_median_metrics", ["bench_runs"], MEDIANS, "SELECT * FROM medians")
rest("a8_daily_medians", ["bench_runs"], MEDIANS, "SELECT * FROM medians")
rest("a9_writer_comparison", ["bench_runs"], COMPARED, """SELECT c / nullif(b, 0) AS output_stage_ratio_candidate_vs_baseline,
 (b - c) / nullif(b, 0) AS output_stage_reduction_fraction, b / nullif(c, 0) AS output_stage_speedup_factor_baseline_vs_candidate FROM both_writers""")
rest("a10_guardrail", ["bench_runs"], COMPARED, """SELECT coalesce(b / nullif(c, 0) >= 3.0, false) OR coalesce((b - c) / nullif(b, 0) >= 0.6, false) AS passed,
 CASE WHEN b / nullif(c, 0) >= 3.0 THEN 'speedup' WHEN (b - c) / nullif(b, 0) >= 0.6 THEN 'reduction_with_justification' ELSE 'failed' END AS route,
 'layout parity work' AS justification FROM both_writers""")
rest("a11_run_counts", GRID, UPDATES, """SELECT t.workbook, coalesce(u.n, 0) AS update_count, t.n AS classified_count
FROM (SELECT workbook, count(*) AS n FROM targets GROUP BY workbook) t LEFT JOIN (SELECT workbook, count(*) AS n FROM updates GROUP BY workbook) u ON t.workbook = u.workbook""")

# --- windows -------------------------------------------------------------------------------------------------

rest("w1_last_write", GRID, WINNERS, "SELECT workbook, sheet_name, row_num, col_num, value FROM winners")
rest("w2_progress", ["post_list"], f"""{RESULTS}, numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY workbook ORDER BY row_num) AS INT) AS idx,
 count(*) OVER (PARTITION BY workbook) AS total FROM results)""",
     "SELECT workbook, row_num, idx, total, concat('[', idx, '/', total, '] row=', row_num, ' (rule) -> ', category) AS line FROM numbered")


def islands(source: str) -> str:
    return f"""breaks AS (SELECT *, CASE WHEN lag(col_num) OVER w = col_num - 1 AND lag(attrs) OVER w = attrs THEN 0 ELSE 1 END AS b
 FROM {source} WINDOW w AS (PARTITION BY workbook, sheet_name ORDER BY col_num)),
runs AS (SELECT *, sum(b) OVER (PARTITION BY workbook, sheet_name ORDER BY col_num) AS island FROM breaks)"""


ISLANDS = "SELECT workbook, sheet_name, CAST(min(col_num) AS INT) AS start_col, CAST(max(col_num) AS INT) AS end_col, min(attrs) AS attrs FROM runs GROUP BY workbook, sheet_name, island"
rest("w3_coalesce_ranges", ["column_ranges"], f"""cols AS (SELECT workbook, sheet_name, col_num, max(attrs) AS attrs
 FROM (SELECT workbook, sheet_name, unnest(range(start_col, end_col + 1)) AS col_num, attrs FROM column_ranges) GROUP BY ALL), {islands('cols')}""", ISLANDS)
rest("w4_first_violation", ["cards", "cells", "writes"], f"{VIOLATIONS}, {FIRST_VIOLATION}", "SELECT * FROM first_violation")
KEPT = """kept AS (SELECT workbook, sheet_name, sheet_idx AS old_idx,
 CAST(row_number() OVER (PARTITION BY workbook ORDER BY sheet_idx) - 1 AS INT) AS sheet_idx FROM sheets WHERE sheet_name <> 'S2')"""
rest("w5_reindexed_sheets", ["sheets"], KEPT, "SELECT * FROM kept")

# --- sorts --------------------------------------------------------------------------------------------------------

rest("o1_summary_sorted", ["post_list"], RESULTS, summary("results") + " ORDER BY 1, 2")
rest("o2_targets_sorted", ["post_list"], TARGETS, "SELECT * FROM targets ORDER BY workbook, row_num")
check("o3_newest_per_user", [], """SELECT user_id, path, modified FROM (SELECT user_id, CAST(event_id AS VARCHAR) AS path, ts AS modified,
 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn FROM events) WHERE rn = 1""")
rest("o4_sorted_changes", PARTS, CHANGES, "SELECT workbook, string_agg(part, ',' ORDER BY part) AS parts FROM changes WHERE status = 'changed' GROUP BY workbook")

# --- sets -----------------------------------------------------------------------------------------------------------

check("e1_part_difference", PARTS, """SELECT *, 'added' AS side FROM (SELECT workbook, part FROM parts_right EXCEPT SELECT workbook, part FROM parts_left)
UNION ALL SELECT *, 'removed' FROM (SELECT workbook, part FROM parts_left EXCEPT SELECT workbook, part FROM parts_right)""")
rest("e2_changed_in_both", PARTS, CHANGES, "SELECT workbook, part FROM changes WHERE status = 'changed'")
CORNERS = """corners AS (SELECT *, split_part(cell_range, ':', 1) AS a, split_part(cell_range, ':', 2) AS z FROM ranges),
expanded AS (SELECT workbook, sheet_name, cell_range, c, unnest(range(CAST(substr(a, 2) AS INT), CAST(substr(z, 2) AS INT) + 1)) AS r
 FROM (SELECT *, unnest(range(ascii(a), ascii(z) + 1)) AS c FROM corners))"""
rest("e3_expand_ranges", ["ranges"], CORNERS, "SELECT workbook, sheet_name, cell_range, concat(chr(CAST(c AS INT)), r) AS cell_ref FROM expanded")
rest("e4_writable_surface", ["ranges", "cards"], f"{CORNERS}, {ALL_CARDS}", """SELECT workbook, sheet_name, concat(chr(CAST(c AS INT)), r) AS cell_ref FROM expanded
UNION SELECT workbook, sheet_name, cell_ref FROM all_cards""")
check("e5_allowed_hashes", ["workbooks"], "SELECT workbook, CASE WHEN file_sha256 = workbook_xml_sha256 THEN file_sha256 ELSE concat(least(file_sha256, workbook_xml_sha256), ',', greatest(file_sha256, workbook_xml_sha256)) END AS hashes FROM workbooks")
rest("e8_unexpected_changes", PARTS + ["sheets"], CHANGES, """SELECT workbook, part FROM changes c WHERE status = 'changed' AND part <> 'xl/part25.xml'
 AND NOT starts_with(part, 'xl/media/') AND NOT regexp_full_match(part, 'xl/part3[0-9]\\.xml')
 AND NOT EXISTS (SELECT 1 FROM sheets s WHERE s.workbook = c.workbook AND s.part = c.part AND s.sheet_idx <= 2)""")
rest("e8_compiled_allowlist", PARTS + ["sheets"], CHANGES, """SELECT workbook, part FROM changes c WHERE status = 'changed' AND part <> 'xl/part25.xml'
 AND NOT starts_with(part, 'xl/drawings/') AND NOT regexp_full_match(part, 'xl/part3[0-9]\\.xml')
 AND NOT EXISTS (SELECT 1 FROM sheets s WHERE s.workbook = c.workbook AND s.part = c.part AND (s.sheet_name = 'S0' OR s.sheet_idx = 4))""")
check("e6_state_variants", ["sheets"], f"""SELECT workbook, CASE WHEN length(workbook) % 2 = 0
 THEN concat({STATES}, ';', coalesce(string_agg(concat(sheet_name, '=', state), ',' ORDER BY sheet_name) FILTER (state = 'hidden'), ''))
 ELSE {STATES} END AS variants FROM sheets GROUP BY workbook""")
rest("e7_target_variants", ["cards"], f"""placed AS (SELECT DISTINCT workbook, sheet_name, concat({letters('(card_start + 1)')}, '5') AS ref FROM cards),
per_sheet AS (SELECT workbook, sheet_name, string_agg(ref, ',' ORDER BY ref) AS refs FROM placed GROUP BY workbook, sheet_name),
own AS (SELECT workbook, string_agg(concat(sheet_name, '=', refs), ' ' ORDER BY sheet_name) AS v FROM per_sheet GROUP BY workbook)""",
     "SELECT workbook, concat(least(v, 'S0='), ';', greatest(v, 'S0=')) AS variants FROM own")
rest("e9_branches", GRID, UPDATES, "SELECT workbook, branch, count(*) AS n FROM updates GROUP BY workbook, branch")

# --- layout -----------------------------------------------------------------------------------------------------------

ITEM = "l_orderkey, l_linenumber, l_partkey"
check("l1_page_count", [], f"SELECT {ITEM}, CASE WHEN l_partkey < 2 THEN 0 ELSE CAST(ceil((l_partkey - 1) / 6.0) AS INT) END AS pages FROM lineitem")
check("l2_shift_column", [], f"SELECT {ITEM}, {shifted('l_partkey')} AS col FROM lineitem")
AREA = f"concat('''', sheet_name, '''!$B$2:$', {letters('e')}, '$35')"
AREAS = f"""{MAX_COLS}, areas AS (SELECT workbook, sheet_name, {AREA} AS print_area FROM (SELECT *, CASE WHEN max_col < 2 THEN 2 ELSE {shifted('max_col')} + 1 END AS e
 FROM max_cols WHERE sheet_name NOT IN ('주현황보고', '2026 list')))"""
rest("l3_print_area", ["cells"], AREAS, "SELECT * FROM areas")
check("l4_shift_marker", [], f"SELECT {ITEM}, {shifted('(l_partkey + 1)')} - 1 AS col FROM lineitem")
check("l5_shift_refs", [], f"""SELECT {ITEM}, l_suppkey, concat({letters(shifted('l_linenumber'))}, l_partkey, ' B2:', {letters(shifted('(2 + l_suppkey % 24)'))}, '35 other') AS refs FROM lineitem""")
check("l6_shift_spans", [], f"SELECT {ITEM}, concat({shifted('l_linenumber')}, ':', {shifted('l_partkey')}) AS span FROM lineitem")
rest("l7_paged_columns", ["column_ranges", "cells"], f"""{MAX_COLS}, disjoint AS (SELECT workbook, sheet_name, start_col, attrs, least(end_col, coalesce(lead(start_col) OVER (PARTITION BY workbook, sheet_name ORDER BY start_col) - 1, end_col)) AS end_col
 FROM (SELECT workbook, sheet_name, start_col, max(attrs) AS attrs, max(end_col) AS end_col FROM column_ranges GROUP BY workbook, sheet_name, start_col)),
opened AS (SELECT workbook, sheet_name, unnest(range(start_col, end_col + 1)) AS c, attrs FROM disjoint),
cols AS (SELECT workbook, sheet_name, {shifted('c')} AS col_num, attrs FROM opened
 UNION ALL SELECT workbook, sheet_name, 1 + p * 7, '{{"customWidth":"1","width":"0.875"}}' FROM (SELECT workbook, sheet_name,
  unnest(range(1, CAST(ceil((max_col - 1) / 6.0) AS INT) + 1)) AS p FROM max_cols)), {islands('cols')}""", ISLANDS)
check("l8_repaginate", ["cells"], f"""SELECT workbook, sheet_name, row_num, CASE WHEN sheet_name IN ('주현황보고', '2026 list') THEN col_num ELSE {shifted('col_num')} END AS col_num, value FROM cells""")
rest("l9_defined_names", ["names", "sheets", "cells"], f"""{AREAS}, {KEPT},
gone AS (SELECT workbook, sheet_idx FROM sheets WHERE sheet_name = 'S2'),
scoped AS (SELECT n.workbook, n.name, n.text, n.local_sheet_id, k.sheet_idx AS new_id FROM names n
 LEFT JOIN kept k ON k.workbook = n.workbook AND k.old_idx = n.local_sheet_id
 WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.workbook = n.workbook AND g.sheet_idx = n.local_sheet_id))""",
     """SELECT workbook, name, coalesce(new_id, local_sheet_id) AS local_sheet_id, text FROM scoped WHERE NOT (name = '_xlnm.Print_Area' AND new_id IS NOT NULL)
UNION ALL SELECT a.workbook, '_xlnm.Print_Area', k.sheet_idx, a.print_area FROM areas a JOIN kept k ON a.workbook = k.workbook AND a.sheet_name = k.sheet_name""")
check("l10_active_tab", ["tabs", "sheets"], """SELECT t.workbook, CASE WHEN active_tab = g.sheet_idx THEN 0 WHEN active_tab > g.sheet_idx THEN active_tab - 1 ELSE active_tab END AS active_tab
FROM tabs t LEFT JOIN (SELECT workbook, sheet_idx FROM sheets WHERE sheet_name = 'S2') g ON t.workbook = g.workbook""")
rest("l11_page_outlines", ["cells"], f"""{MAX_COLS}, paged AS (SELECT workbook, sheet_name, unnest(range(1, CAST(ceil((max_col - 1) / 6.0) AS INT) + 1)) AS page
 FROM max_cols WHERE max_col >= 2 AND sheet_name NOT IN ('주현황보고', '2026 list')),
rows_of AS (SELECT *, unnest(range(2, 36)) AS row_num FROM paged), spots AS (SELECT *, unnest(range(0, 6)) AS s FROM rows_of)""",
     """SELECT workbook, sheet_name, CAST(page AS INT) AS page, CAST(row_num AS INT) AS row_num, CAST(2 + (page - 1) * 7 + s AS INT) AS col_num, s = 0 AS left_edge, s = 5 AS right_edge,
 row_num = 2 AS top_edge, row_num = 35 AS bottom_edge FROM spots""")

# --- validation ----------------------------------------------------------------------------------------------------------

ORDER = "2026 list,S0,S1,S2,S3,S4,S5,S6,S7"
GOOD_STATES = ",".join(f"{n}={'hidden' if n == 'S7' else 'visible'}" for n in sorted(ORDER.split(",")))
PRINTS = f"""{ALL_CARDS}, per_sheet AS (SELECT c.workbook, c.sheet_name, string_agg(c.cell_ref, ',' ORDER BY c.col_num) AS refs
 FROM all_cards c JOIN sheets s ON c.workbook = s.workbook AND c.sheet_name = s.sheet_name GROUP BY c.workbook, c.sheet_name),
own AS (SELECT workbook, string_agg(concat(sheet_name, '=', refs), ';' ORDER BY sheet_name) AS card_refs FROM per_sheet GROUP BY workbook),
catalogue AS (SELECT workbook, count(*) AS n, string_agg(sheet_name, ',' ORDER BY sheet_idx) AS sheet_order, {STATES} AS states,
 count(*) FILTER (sheet_name = '2026 list') AS targets FROM sheets GROUP BY workbook),
prints AS (SELECT w.*, c.n, c.sheet_order, c.states, c.targets, o.card_refs FROM workbooks w LEFT JOIN catalogue c ON c.workbook = w.workbook LEFT JOIN own o ON o.workbook = w.workbook)"""
EXPECTED_CARDS = """expected AS (SELECT string_agg(e, ';' ORDER BY e) AS card_refs FROM (SELECT concat('S', s % 8, '=',
 string_agg(['C5', 'I5', 'O5', 'U5', 'AA5'][s // 8 + 1], ',' ORDER BY s)) AS e FROM (SELECT unnest(range(0, 40)) AS s)
 WHERE s NOT IN (3, 14, 25, 36, 5, 18, 31, 1, 35) GROUP BY s % 8))"""
TESTS = [
    ("family NOT IN ('f0', 'f1')", "unsupported_missing_contract", "no contract for this workbook family"),
    ("n IS NULL", "unsupported_missing_catalogue", "the sheet catalogue of the workbook cannot be read"),
    ("n <> 9", "unsupported_sheet_count", "sheet count differs from supported workbook family"),
    ("targets = 0", "unsupported_missing_target_sheet", "missing required sheet 2026 list"),
    (f"sheet_order <> '{ORDER}'", "unsupported_sheet_order", "sheet order differs from supported workbook family"),
    (f"states <> '{GOOD_STATES}'", "unsupported_sheet_state", "sheet hidden-state map differs from supported workbook family"),
    ("card_refs IS DISTINCT FROM (SELECT card_refs FROM expected)", "unsupported_missing_linked_card_layout",
     "linked-card write targets differ from supported workbook family"),
    ("workbook_xml_sha256 <> sha256(family)", "unsupported_workbook_family_signature", "workbook.xml fingerprint differs from supported workbook family"),
]
CODE = "CASE " + " ".join(f"WHEN {t} THEN '{c}'" for t, c, _ in TESTS) + " END AS code"
DETAIL = "CASE " + " ".join(f"WHEN {t} THEN '{d}'" for t, _, d in TESTS) + " END AS detail"
CHECKED = f"{PRINTS}, {EXPECTED_CARDS}, checked AS (SELECT workbook, family, {CODE}, {DETAIL} FROM prints)"
rest("v1_contract_check", ["cards", "sheets", "workbooks"], CHECKED, "SELECT * FROM checked")
rest("v2_runtime_contract", ["cards", "sheets", "workbooks"], PRINTS, "SELECT workbook, family, '2026 list' AS target_sheet, states, coalesce(card_refs, '') AS card_refs FROM prints WHERE family IN ('f0', 'f1')")
DECIDED = f"""{CHECKED}, {VIOLATIONS.replace(ALL_CARDS + ', ', '')}, {FIRST_VIOLATION},
decided AS (SELECT c.workbook, CASE WHEN c.code IS NULL AND v.code IS NULL THEN 'primary_template_value_only' ELSE 'unsupported_variant' END AS writer,
 'hard_fail' AS policy, c.code IS NULL AND v.code IS NULL AS supported, coalesce(c.code, v.code) AS reason_code, coalesce(c.detail, v.detail) AS detail
 FROM checked c LEFT JOIN first_violation v ON v.workbook = c.workbook)"""
BOOKS = ["cards", "sheets", "workbooks", "cells", "writes"]
rest("v3_writer_decision", BOOKS, DECIDED, "SELECT * FROM decided")
rest("v4_supported_updates", BOOKS, DECIDED, "SELECT w.* FROM writes w WHERE w.workbook IN (SELECT workbook FROM decided WHERE supported)")
rest("v4_rejects", BOOKS, DECIDED, "SELECT workbook, policy, reason_code, detail FROM decided WHERE NOT supported")


def drift(writable: str, wanted: str) -> str:
    return f"""drift AS (SELECT * FROM (SELECT coalesce(l.workbook, r.workbook) AS workbook, coalesce(l.sheet_name, r.sheet_name) AS sheet_name,
 coalesce(l.cell_ref, r.cell_ref) AS cell_ref, l.workbook IS NULL OR r.workbook IS NULL AS one_sided,
 coalesce(l.value, '') IS DISTINCT FROM coalesce(r.value, '') AS v, l.cell_type IS DISTINCT FROM r.cell_type AS t,
 (l.cell_type IS NULL) <> (r.cell_type IS NULL) AS tn,
 l.has_formula IS DISTINCT FROM r.has_formula OR l.formula IS DISTINCT FROM r.formula OR l.style IS DISTINCT FROM r.style AS f
 FROM grid_before l FULL JOIN grid_after r ON l.workbook = r.workbook AND l.sheet_name = r.sheet_name AND l.cell_ref = r.cell_ref) d
 WHERE ({wanted}) AND (one_sided OR f OR CASE WHEN {writable} THEN tn ELSE v OR t END))"""


KNOWN = "EXISTS (SELECT 1 FROM sheets s WHERE s.workbook = d.workbook AND s.sheet_name = d.sheet_name{more})"
rest("v6_cell_drift", ["grid_before", "grid_after", "sheets"], drift(f"""(cell_ref = 'C5' AND {KNOWN.format(more='')}) OR {KNOWN.format(more=' AND s.sheet_idx = 3')}""", "true"), "SELECT workbook, sheet_name, cell_ref FROM drift")
IN_CHANGED = KNOWN.format(
    more=" AND s.sheet_idx IN (1, 2) AND EXISTS (SELECT 1 FROM changes c WHERE c.status = 'changed' AND c.workbook = s.workbook AND c.part = s.part)")
rest("v5_package_errors", PARTS + ["grid_before", "grid_after", "sheets", "cells"], f"""{CHANGES}, {drift(f"""cell_ref = 'C5' OR {KNOWN.format(more=' AND s.sheet_idx = 2')}""", IN_CHANGED)},
col_sums AS (SELECT workbook, sheet_name, max(col_num) AS m FROM cells GROUP BY ALL),
objects AS (SELECT 'l' AS side, workbook, count(*) FILTER (part LIKE 'xl/media/%') AS m, count(*) FILTER (part LIKE 'xl/drawings/%') AS d FROM parts_left GROUP BY workbook
 UNION ALL SELECT 'r', workbook, count(*) FILTER (part LIKE 'xl/media/%'), count(*) FILTER (part LIKE 'xl/drawings/%') FROM parts_right GROUP BY workbook)""",
     """SELECT workbook, concat('unexpected_', status) AS error_kind, part AS item FROM changes WHERE status IN ('added', 'removed')
UNION ALL SELECT workbook, 'unexpected_changed', part FROM changes c WHERE status = 'changed' AND NOT starts_with(part, 'xl/media/')
 AND NOT EXISTS (SELECT 1 FROM sheets s WHERE s.workbook = c.workbook AND s.part = c.part AND s.sheet_idx IN (1, 2))
UNION ALL SELECT workbook, 'drift', concat(sheet_name, '!', cell_ref) FROM drift
UNION ALL SELECT workbook, 'sheet_states', '' FROM sheets WHERE sheet_name = 'S5'
UNION ALL SELECT workbook, 'merges', sheet_name FROM col_sums WHERE m % 1000 <> m % 29
UNION ALL SELECT l.workbook, 'media_count', '' FROM objects l JOIN objects r ON l.side = 'l' AND r.side = 'r' AND l.workbook = r.workbook AND l.m <> r.m
UNION ALL SELECT l.workbook, 'drawing_count', '' FROM objects l JOIN objects r ON l.side = 'l' AND r.side = 'r' AND l.workbook = r.workbook AND l.d <> r.d""")
TREE = f"""{NUMBERED}, firsts AS (SELECT b.workbook, b.n, s.sheet_name FROM books b JOIN sheets s
 ON s.workbook = b.workbook AND s.part = 'xl/worksheets/sheet1.xml'),
held AS (SELECT f.*, p.row_num, p.doc_id % 40 % 6 = 2 AS formula, concat('worksheet/sheetData[0]/row[', p.row_num, ']') AS line
 FROM firsts f JOIN post_list p ON p.workbook = f.workbook WHERE f.n % 5 <> 3 AND f.n % 4 <> 1),
seen AS (SELECT DISTINCT workbook, n, sheet_name FROM held),
tree AS (SELECT workbook, sheet_name, 'worksheet/dimension[0]' AS path, 'attributes' AS change, NULL AS cell FROM seen WHERE n % 4 = 0
 UNION ALL SELECT workbook, sheet_name, line, 'attributes', NULL FROM held WHERE n % 4 = 2 AND row_num = 7
 UNION ALL SELECT workbook, sheet_name, 'worksheet/ignoredErrors[0]', 'added', NULL FROM seen WHERE n % 7 = 1
 UNION ALL SELECT workbook, sheet_name, concat(line, '/c[H', row_num, ']/f[0]'), 'attributes', concat('H', row_num) FROM held WHERE n % 7 = 2 AND formula
 UNION ALL SELECT workbook, sheet_name, concat(line, '/c[G7]'), 'attributes', 'G7' FROM held WHERE n % 7 = 3 AND row_num = 7
 UNION ALL SELECT workbook, sheet_name, concat(line, '/c[J7]/v[0]'), 'text', 'J7' FROM held WHERE n % 7 = 0 AND row_num = 7
 UNION ALL SELECT workbook, sheet_name, concat(line, '/c[G', row_num, ']/is[0]/t[0]'), 'text', concat('G', row_num) FROM held
 WHERE n % 7 = 6 AND row_num NOT BETWEEN 5 AND 220)"""
rest("v6_sheet_drift", ["sheets", "post_list"], TREE, """SELECT workbook, sheet_name, path, change FROM tree
UNION ALL SELECT workbook, sheet_name, 'worksheet', 'removed' FROM firsts WHERE n % 5 = 3""")
rest("v5_package_report", ["sheets", "post_list"], TREE, """
SELECT DISTINCT workbook, CASE WHEN cell IS NULL THEN 'sheet_drift' ELSE 'drift' END AS error_kind, concat(sheet_name, '!', coalesce(cell, path)) AS item FROM tree
UNION ALL SELECT workbook, 'unexpected_changed', 'xl/workbook.xml' FROM books WHERE n % 5 = 1
UNION ALL SELECT workbook, k.kind, '' FROM books, (VALUES ('sheet_order'), ('sheet_states'), ('relationship_targets'), ('defined_names')) AS k(kind) WHERE n % 5 = 1
UNION ALL SELECT workbook, 'unexpected_changed', 'xl/sharedStrings.xml' FROM books WHERE n % 5 = 2
UNION ALL SELECT workbook, 'unexpected_removed', 'xl/worksheets/sheet1.xml' FROM books WHERE n % 5 = 3
UNION ALL SELECT workbook, 'merges', sheet_name FROM firsts WHERE n % 5 IN (1, 3)""")
EVIDENCE = """fresh AS (SELECT DISTINCT a.folder, a.path FROM listing_after a LEFT JOIN listing_before b ON a.folder = b.folder AND a.path = b.path
 WHERE a.modified >= TIMESTAMP '2024-01-10 00:00:00' AND (b.path IS NULL OR a.modified > b.modified OR a.length <> b.length))"""
LISTINGS = ["listing_before", "listing_after"]
rest("v7_new_evidence", LISTINGS, EVIDENCE, "SELECT * FROM fresh")
rest("v8_gate_verdict", LISTINGS, f"""{EVIDENCE}, opened AS (SELECT folder, min(length) % 2 = 0 AS normal_open, max(length) % 2 = 0 AS repair_open FROM listing_after GROUP BY folder),
found AS (SELECT folder, count(*) AS n FROM fresh GROUP BY folder),
judged AS (SELECT o.*, coalesce(f.n, 0) AS evidence, coalesce(f.n, 0) > 0 OR (NOT normal_open AND repair_open) AS repair_detected FROM opened o LEFT JOIN found f ON o.folder = f.folder)""",
     "SELECT folder, evidence, repair_detected, NOT repair_detected AND normal_open AS passed FROM judged")
