"""Grids, posts, pages and snapshots derived from the given tables.

Each view is SQL that Spark and the checking engine both read, so the inputs of
a query and of its check are the same rows.  Views read whole tables and grow
with them: 40 documents make one workbook, every document is one post, one card
and one package part.  A third of all posts point to one page.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

PHRASES = """
SELECT * FROM (VALUES
 (0,'[교환] 사이즈 바꿔요'), (1,'[교환] 블랙150 -> 140'), (2,'[구해요] 130 구해요'),
 (3,'[구해요] 소환합니다'), (4,'(완료)몬치치 오버롤 90사이즈'), (5,'원래 마감이 좀 깔끔치 못한가요?'),
 (6,'왜 가벼워야 하는지 이제 알겠네요'), (7,'구매 성공'), (8,'150 > 140'), (9,'찾고 있어요'),
 (10,'이건 진짜 비추천'), (11,'왕비추천'), (12,'강추'), (13,'추천부탁'),
 (14,'무신사) 키즈 79000원 무배'), (15,'공홈 오픈'), (16,'구매처 아시는분'), (17,'79,000원 무배'),
 (18,'약79000원'), (19,'품절풀렸어요'), (20,'실망 자국'), (21,'만족'), (22,'h-street'),
 (23,'오늘 배송 빠르네요'), (24,'애매한 제목'), (25,'성분이 뭔가요'), (26,'비 오는 날'),
 (27,'마감 임박'), (28,'추천해 주세요'), (29,'그냥 그런 날')) AS t(i, phrase)
"""

ANSWERS = """
SELECT * FROM (VALUES
 (0,'반응_문의'), (1,'반응_교환'), (2,'반응_구해요'), (3,'반응_정보'), (4,'반응_거래'),
 (5,'반응_마감문의'), (6,'반응_단순반응'), (7,'반응_제품칭찬'), (8,'반응_제품비판'),
 (9,'반응_일반감상'), (10,'반응_구매추천'), (11,'반응_구매비추천'), (12,'반응_기타'),
 (13,'알 수 없음'), (14,''), (15,'긍정_제품후기'), (16,'비추천'), (17,'(완료) 거래'),
 (18,'마감이 별로인가요'), (19,'정답은 반응_문의 입니다'), (20,'반응_정보 또는 반응_교환'),
 (21,'  반응_거래  '), (22,'추천드립니다'), (23,'기뻐요'), (24,'실망'), (25,'만족'),
 (26,'반응_교환 아니면 반응_기타'), (27,'null'), (28,'missing'), (29,'broken'), (30,'empty'),
 (31,'12'), (32,'반응_일반감상')) AS t(i, answer)
"""

KEYED_DOCUMENTS = """
SELECT doc_id, text, wb, slot, concat('wb', CAST(wb AS STRING)) AS workbook,
       CAST(1 + 6 * slot AS INT) AS row_num,
       (doc_id * 13) % (SELECT count(*) FROM {pages}) AS page_key,
       ((doc_id - slot + (slot * 7) % 40) * 13) % (SELECT count(*) FROM {pages}) AS card_key,
       (SELECT max(url) FROM {pages} WHERE page_id = 0) AS hot_url
FROM (SELECT doc_id, text, CAST((doc_id - doc_id % 40) / 40 AS BIGINT) AS wb, doc_id % 40 AS slot
      FROM {documents}) d
"""

POST_LIST = """
SELECT k.doc_id, k.workbook, k.row_num,
       CASE WHEN (k.doc_id + k.wb) % 5 = 0 THEN '긍정_제품후기'
            WHEN (k.doc_id + k.wb) % 5 = 1 THEN '부정_제품반응' ELSE '반응_제품반응' END AS marker,
       CASE WHEN k.doc_id % 37 = 0 THEN '   '
            ELSE concat('  ', h.phrase, chr(10), ' ', k.text, '  ') END AS title,
       CASE WHEN k.doc_id % 7 = 0 THEN NULL WHEN k.doc_id % 11 = 0 THEN ''
            WHEN k.doc_id % 3 = 0 THEN k.hot_url ELSE p.url END AS link
FROM {keyed} k JOIN {phrases} h ON (k.doc_id + 7 * k.wb) % 30 = h.i
JOIN {pages} p ON p.page_id = k.page_key
"""

CARDS = """
SELECT k.workbook, CAST(1 + k.slot % 8 AS INT) AS sheet_idx,
       concat('S', CAST(k.slot % 8 AS STRING)) AS sheet_name,
       CAST(2 + 6 * ((k.slot - k.slot % 8) / 8) AS INT) AS card_start,
       CASE WHEN k.slot % 11 = 3 THEN 'Voice of customer' ELSE 'Voice Of Customer' END AS anchor,
       CASE WHEN k.slot % 13 = 5 OR (k.wb % 9 = 8 AND k.slot = 6) THEN '기타' ELSE '주요 이슈' END AS header,
       CASE WHEN (k.slot + k.wb) % 6 = 0 THEN '긍정_제품후기' ELSE '반응_제품반응' END AS category,
       CASE WHEN k.slot % 17 = 1 THEN '' WHEN k.slot % 24 = 0 THEN k.hot_url ELSE p.url END AS link,
       k.slot % 19 = 0 AS has_formula
FROM {keyed} k JOIN {pages} p ON p.page_id = k.card_key
"""

CELLS = """
SELECT workbook, 0 AS sheet_idx, '2026 list' AS sheet_name, row_num, col_num,
       CASE WHEN col_num = 7 THEN marker WHEN col_num = 10 THEN title
            WHEN doc_id % 2 = 0 THEN '원문' ELSE link END AS value,
       CASE WHEN col_num = 11 AND doc_id % 2 = 0 THEN coalesce(link, 'https://example.com/none') END AS hyperlink,
       false AS has_formula
FROM (SELECT *, unnest([7, 10, 11]) AS col_num FROM {post_list}) p
UNION ALL
SELECT workbook, sheet_idx, sheet_name, CASE WHEN piece < 2 THEN 2 + 2 * piece ELSE 5 END,
       CAST(card_start + CASE WHEN piece = 1 THEN 4 WHEN piece = 3 THEN 1 ELSE 0 END AS INT),
       CASE WHEN piece = 0 THEN anchor WHEN piece = 1 THEN link WHEN piece = 2 THEN header ELSE category END,
       CAST(NULL AS STRING), has_formula AND piece = 3
FROM (SELECT *, unnest([0, 1, 2, 3]) AS piece FROM {cards}) k
"""

SHEETS = """
SELECT workbook, CASE WHEN dv = 5 AND idx = 1 THEN 2 WHEN dv = 5 AND idx = 2 THEN 1 ELSE idx END AS sheet_idx,
       CASE WHEN dv = 4 AND idx = 0 THEN 'list' ELSE sheet_name END AS sheet_name,
       CASE WHEN sheet_name = 'S7' OR (dv = 6 AND sheet_name = 'S6') THEN 'hidden' ELSE 'visible' END AS state,
       concat('xl/worksheets/sheet', CAST(idx + 1 AS STRING), '.xml') AS part
FROM (SELECT DISTINCT workbook, CAST(substr(workbook, 3) AS BIGINT) % 8 AS dv, sheet_idx AS idx, sheet_name
      FROM {cells}) s
WHERE NOT (dv = 3 AND sheet_name = 'S7')
"""

WORKBOOKS = """
SELECT workbook, family, sha256(workbook) AS file_sha256, sha256(seed) AS workbook_xml_sha256
FROM (SELECT workbook, family, CASE WHEN wb % 8 = 7 THEN workbook ELSE family END AS seed
      FROM (SELECT CASE WHEN twin = 1 THEN concat(workbook, '-cut') ELSE workbook END AS workbook, wb,
                   CASE WHEN wb % 5 = 3 THEN 'unknown' ELSE concat('f', CAST(wb % 2 AS STRING)) END AS family
            FROM (SELECT workbook, wb, unnest([0, 1]) AS twin
                  FROM (SELECT DISTINCT workbook, CAST(substr(workbook, 3) AS BIGINT) AS wb FROM {cells}) a) t
            WHERE twin = 0 OR wb % 5 = 2) b) c
"""

WRITES = """
SELECT workbook, CAST(doc_id AS INT) AS seq,
       CASE WHEN wb % 3 = 1 THEN '2026 list' WHEN doc_id % 97 = 5 THEN 'other'
            WHEN doc_id % 4 = 1 THEN concat('S', CAST(slot % 8 AS STRING)) ELSE '2026 list' END AS sheet_name,
       CASE WHEN wb % 3 <> 1 AND doc_id % 97 <> 5 AND doc_id % 4 = 1
            THEN concat(CASE WHEN slot < 8 THEN 'C' WHEN slot < 16 THEN 'I' WHEN slot < 24 THEN 'O'
                             WHEN slot < 32 THEN 'U' ELSE 'AA' END, '5')
            ELSE concat('G', CAST(CASE WHEN wb % 3 = 0 THEN row_num ELSE 5 + slot END AS STRING)) END AS cell_ref
FROM {keyed}
"""

ARTICLE_PAGES = """
SELECT page_id, url,
       replace(replace(html, '<article>', concat(
         CASE WHEN page_id % 3 = 0 THEN '<section class="article viewer">'
              WHEN page_id % 3 = 1 THEN '<section id="a" class=''main viewer article''>'
              ELSE '<section class="artice viewer wide">' END,
         CASE WHEN page_id % 5 = 0 THEN '<p>회원간의 거래 분쟁에 대한 공론화 금지 안내</p>' ELSE '' END,
         CASE WHEN page_id % 4 = 1 THEN '<p>에이치스트릿 재입고 되었어요.</p>' ELSE '' END,
         CASE WHEN page_id % 17 = 4 THEN '<p>카페홈</p>' ELSE '' END,
         CASE WHEN page_id % 19 = 3 THEN repeat('a/', 100) ELSE '' END)),
       '</article>', '</section>') AS html
FROM {pages}
"""

ATTEMPTS = """
SELECT e.item, e.model, e.attempt,
       CASE WHEN e.event_type IN ('error', 'signup', 'view') THEN 'failed' ELSE 'ok' END AS status,
       CASE WHEN a.i = 27 THEN '{{"choices":[{{"message":{{"content":null}}}}]}}'
            WHEN a.i = 28 THEN '{{"choices":[{{"message":{{}}}}]}}'
            WHEN a.i = 29 THEN '{{"choices":[{{"message"'
            WHEN a.i = 30 THEN '{{"choices":[]}}'
            WHEN a.i = 31 THEN '{{"choices":[{{"message":{{"content":12}}}}]}}'
            ELSE concat('{{"choices":[{{"message":{{"content":"', a.answer, '"}}}}]}}') END AS response
FROM (SELECT event_id, event_type, CAST((event_id - event_id % 8) / 8 AS BIGINT) AS item,
             CASE WHEN event_id % 2 = 0 THEN 'A' ELSE 'B' END AS model,
             CAST((event_id % 8 - event_id % 2) / 2 + 1 AS INT) AS attempt FROM {events}) e
JOIN {answers} a ON (e.event_id * 7) % 33 = a.i
"""

MODEL_ANSWERS = """
SELECT d.doc_id, CASE WHEN d.doc_id % 29 = 0 THEN NULL WHEN d.doc_id % 2 = 0 THEN a.answer
                      ELSE concat(a.answer, ' ', d.text) END AS answer
FROM {documents} d JOIN {answers} a ON d.doc_id % 33 = a.i
"""

PARTS_LEFT = """
SELECT workbook, part, sha256(text) AS sha256 FROM (
  SELECT workbook, text,
         CASE WHEN slot < 9 THEN concat('xl/worksheets/sheet', CAST(slot + 1 AS STRING), '.xml')
              WHEN slot < 16 THEN concat('xl/media/image', CAST(slot AS STRING), '.png')
              WHEN slot < 21 THEN concat('xl/drawings/drawing', CAST(slot AS STRING), '.xml')
              ELSE concat('xl/part', CAST(slot AS STRING), '.xml') END AS part
  FROM {keyed}) p
"""

PARTS_RIGHT = """
SELECT workbook, CASE WHEN doc_id % 10 = 3 THEN concat(part, '.new') ELSE part END AS part,
       sha256(body) AS sha256 FROM (
  SELECT workbook, doc_id, CASE WHEN doc_id % 9 = 0 THEN concat(text, 'x') ELSE text END AS body,
         CASE WHEN slot < 9 THEN concat('xl/worksheets/sheet', CAST(slot + 1 AS STRING), '.xml')
              WHEN slot < 16 THEN concat('xl/media/image', CAST(slot AS STRING), '.png')
              WHEN slot < 21 THEN concat('xl/drawings/drawing', CAST(slot AS STRING), '.xml')
              ELSE concat('xl/part', CAST(slot AS STRING), '.xml') END AS part
  FROM {keyed}) p
"""

GRID_BEFORE = """
SELECT workbook, sheet_name,
       concat(CASE WHEN col_num > 26 THEN concat('A', chr(38 + col_num)) ELSE chr(64 + col_num) END,
              CAST(row_num AS STRING)) AS cell_ref, value,
       CASE WHEN col_num % 9 = 0 THEN NULL ELSE 'inlineStr' END AS cell_type, has_formula,
       CASE WHEN has_formula THEN concat('A', CAST(row_num AS STRING)) END AS formula, CAST(col_num % 5 AS STRING) AS style
FROM {cells}
"""

GRID_AFTER = """
SELECT workbook, sheet_name,
       concat(CASE WHEN col_num > 26 THEN concat('A', chr(38 + col_num)) ELSE chr(64 + col_num) END,
              CAST(CASE WHEN (row_num * 17 + col_num * 5 + n) % 101 = 7 THEN row_num + 500
                        ELSE row_num END AS STRING)) AS cell_ref,
       CASE WHEN (row_num * 31 + col_num + n) % 29 = 0 THEN concat(coalesce(value, ''), '~') ELSE value END AS value,
       CASE WHEN col_num % 9 = 0 AND n % 4 <> 1 THEN NULL ELSE 'inlineStr' END AS cell_type, has_formula,
       CASE WHEN has_formula THEN concat(CASE WHEN (col_num + n) % 4 = 2 THEN 'B' ELSE 'A' END, CAST(row_num AS STRING)) END AS formula,
       CASE WHEN (row_num * 7 + col_num + n) % 41 = 2 THEN '9' ELSE CAST(col_num % 5 AS STRING) END AS style
FROM (SELECT *, CAST(substr(workbook, 3) AS BIGINT) AS n FROM {cells}) c
"""

COLUMN_RANGES = """
SELECT workbook, sheet_name, card_start AS start_col,
       CAST(card_start + card_start % 7 AS INT) AS end_col,
       CASE WHEN card_start % 4 = 0 THEN '{{"width":"9"}}' ELSE '{{"width":"12"}}' END AS attrs
FROM {cards}
"""

BENCH_RUNS = """
SELECT event_id, CASE WHEN user_id % 5 = 4 THEN 'other' WHEN user_id % 2 = 0 THEN 'primary' ELSE 'legacy' END AS writer,
       value AS load_seconds, value / 8 AS manifest_build_seconds, value * 2 AS classify_seconds,
       CASE WHEN user_id % 2 = 0 THEN value / 4 ELSE value END AS write_seconds,
       value / 4 AS save_seconds, value * 8 AS total_seconds, CAST(ts AS DATE) AS day
FROM {events}
"""

LISTING_BEFORE = """
SELECT concat('root', CAST(user_id % 50 AS STRING)) AS folder,
       concat('repair', CAST(event_id AS STRING), '.xml') AS path, ts AS modified,
       CAST(length(props) AS BIGINT) AS length
FROM {events}
"""

LISTING_AFTER = """
SELECT concat('root', CAST(user_id % 50 AS STRING)) AS folder,
       concat('repair', CAST(CASE WHEN event_id % 10 = 0 THEN -event_id ELSE event_id END AS STRING), '.xml') AS path,
       CASE WHEN event_id % 4 = 1 THEN ts + INTERVAL '1' DAY ELSE ts END AS modified,
       CAST(length(props) + CASE WHEN event_id % 6 = 2 THEN 1 ELSE 0 END AS BIGINT) AS length
FROM {events}
"""

INPUT_LISTING = """
SELECT concat(CAST(user_id AS STRING), '/', event_type, '/', CAST(CAST(ts AS DATE) AS STRING)) AS folder,
       concat('in', CAST(event_id AS STRING), '.xlsx') AS path
FROM {events}
"""

OUTPUT_NAMES = """
SELECT o_orderkey, o_orderdate, concat('order', CAST(o_orderkey AS STRING), '.xlsx') AS name,
       CASE WHEN o_orderkey % 9 = 0 THEN '  ' WHEN o_orderkey % 9 = 1 THEN '..' WHEN o_orderkey % 9 = 2 THEN 'a/b'
            WHEN o_orderkey % 9 = 3 THEN ' main ' WHEN o_orderkey % 9 = 4 THEN chr(92) ELSE o_orderpriority END AS kind
FROM {orders}
"""

NAMES = """
SELECT workbook, '_xlnm.Print_Area' AS name, sheet_idx AS local_sheet_id, concat(sheet_name, '!$A$1:$B$2') AS text
FROM {sheets}
UNION ALL
SELECT workbook, '_xlnm.Print_Titles', sheet_idx, concat(sheet_name, '!$1:$1') FROM {sheets} WHERE sheet_idx % 3 = 2
UNION ALL
SELECT DISTINCT workbook, 'Total', CAST(NULL AS INT), 'SUM(A:A)' FROM {sheets}
"""

TABS = """
SELECT DISTINCT workbook, CAST(CAST(substr(workbook, 3) AS BIGINT) % 9 AS INT) AS active_tab FROM {cells}
"""

RANGES = """
SELECT workbook, sheet_name,
       concat(chr(63 + CAST(card_start AS INT)), CAST(2 + sheet_idx AS STRING), ':',
              CASE WHEN sheet_idx = 3 THEN 'A' ELSE chr(65 + CAST(card_start - card_start % 3 AS INT) % 26) END,
              CAST(5 + sheet_idx % 4 AS STRING)) AS cell_range
FROM {cards}
UNION ALL
SELECT workbook, '2026 list', 'G5:G220' FROM {workbooks}
"""

PHRASE_BYTES = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{phrase.encode('cp949').hex()}')" for i, phrase in re.findall(r"\((\d+),'([^']*)'\)", PHRASES)
) + ") AS t(i, cp949)"

VIEWS: dict[str, str] = {
    "phrase_bytes": PHRASE_BYTES,
    "phrases": PHRASES, "answers": ANSWERS, "keyed": KEYED_DOCUMENTS, "post_list": POST_LIST,
    "cards": CARDS, "cells": CELLS, "sheets": SHEETS, "workbooks": WORKBOOKS, "writes": WRITES,
    "article_pages": ARTICLE_PAGES, "attempts": ATTEMPTS, "model_answers": MODEL_ANSWERS,
    "parts_left": PARTS_LEFT, "parts_right": PARTS_RIGHT, "grid_before": GRID_BEFORE,
    "grid_after": GRID_AFTER, "column_ranges": COLUMN_RANGES, "bench_runs": BENCH_RUNS,
    "listing_before": LISTING_BEFORE, "listing_after": LISTING_AFTER,
    "input_listing": INPUT_LISTING, "output_names": OUTPUT_NAMES, "names": NAMES, "tabs": TABS,
    "ranges": RANGES,
}


def _needs(sql: str) -> list[str]:
    return sorted({n for n in re.findall(r"(?<!\{)\{([a-z_]+)\}(?!\})", sql)})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a derived view, as a DataFrame; each table is listed once for a view."""
    built: dict[str, DataFrame] = {}

    def build(wanted: str) -> DataFrame:
        if wanted not in built:
            if wanted in TABLES:
                built[wanted] = spark.read.parquet(f"{sf_dir}/{wanted}.parquet")
            else:
                sql = re.sub(r"sha256\((\w+)\)", r"sha2(\1, 256)", VIEWS[wanted])
                sql = re.sub(r"unnest\(\[(.*?)\]\)", r"explode(array(\1))", sql)
                built[wanted] = spark.sql(sql, **{n: build(n) for n in _needs(sql)})
        return built[wanted]

    return build(name)


def with_clause(names: list[str]) -> str:
    """``WITH`` text that defines the named views, and those they need, for the checking engine."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for needed in _needs(VIEWS[name]):
            add(needed)
        ordered.append(name)

    for name in names:
        add(name)
    bodies = []
    for name in ordered:
        text = VIEWS[name].strip()
        bodies.append(f"{name} AS ({text.format(**{n: n for n in _needs(text)})})")
    return "WITH " + ",\n".join(bodies)
