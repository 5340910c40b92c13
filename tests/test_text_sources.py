import datetime
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tagloom.functions import model_io
from tagloom.functions.html import with_article_text
from tagloom.functions.lexicon import CATEGORIES
from tagloom.operators import contract, diff, grid, layout
from tagloom.plans import jobs
from tagloom.sources import charset, files, outputs, packages, xml_tree

NOTICE = "회원간의 거래 분쟁에 대한 공론화 금지"
PAGES = [
    ('<div class="big article old viewer"><ul><li>내소식이 없습니다</li><li>글</li></ul></div>', None),
    (f'<section id="s" class="article viewer"><em>알림: {NOTICE}!</em>택배는 언제 오나요</section>', "택배는 언제 오나요"),
    ('<div class="viewer wide article">색이 <b>달라요</b></div>', "색이 \n달라요"),
    ("<DIV id=1 CLASS='x artice big viewer'>old</DIV><p>rest</p>", "old"),
    ('<p class="viewer artice">first</p><div class="article viewer">second</div>', "second"),
    ('<div class="article viewer">a<div>b</div>c</div>', "a\nb"),
    ('<div class="article-body viewer">hyphen</div>', "hyphen"),
    ('<div class="article viewer"></div>outside', None),
    ("no container <b>x</b>", "no container \nx"),
    ("a<script>1<2</script>b<STYLE>s</STYLE >c", "a b\ns\nc"),
    ("&lt;b&gt; &amp;amp; &copy;&#44032;", "<b> &amp; ©가"),
    ("x \n \n\n  y", "x \n \n y"),
    ("/" * 80, "/" * 80), ("/" * 81, None), ("카페홈 글", None), ("", None), (None, None), ("<p> </p>", None),
]


def test_article_text(spark):
    rows = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PAGES)], "i int, html string")
    got = [r.article_text for r in with_article_text(rows).orderBy("i").collect()]
    assert got == [want for _, want in PAGES]


def test_charset_cascade(spark):
    cases = [
        ("신발이 커요".encode("cp949"), "ms949", "신발이 커요"),
        ("재입고".encode("cp949"), None, "재입고"), ("가".encode(), None, "가"), ("가".encode(), "UTF-8", "가"),
        (b"", None, None), (None, "utf-8", None), ("é".encode("latin-1"), "iso-8859-1", "é"),
        ("가".encode("utf-16"), "utf-16", "가"), ("가".encode(), "no-such", "가"), (b"a\xff\xfe\x80b", None, "ab"),
    ]
    rows = spark.createDataFrame([(i, c, d) for i, (c, d, _) in enumerate(cases)], "i int, c binary, d string")
    got = rows.select("i", charset.decode_page(F.col("c"), F.col("d")).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [want for _, _, want in cases]


def test_prompts_name_every_label():
    for prompt in (model_io.TITLE_PROMPT, model_io.BODY_PROMPT):
        assert all(label in prompt for label in CATEGORIES)
        assert "반응_기타" not in prompt


def test_request_body(spark):
    body = spark.range(1).select(model_io.request_body(F.lit('테스트 "제목"')).alias("b")).first().b
    request = json.loads(body)
    assert request["model"] == model_io.FIRST_MODEL
    assert [m["role"] for m in request["messages"]] == ["system", "user"]
    assert request["messages"][0]["content"] == model_io.TITLE_PROMPT + '테스트 "제목"'
    assert request["messages"][1]["content"] == '테스트 "제목"'


@pytest.mark.parametrize(
    "response, want",
    [('{"choices":[{"message":{"content":"반응_교환"}}]}', "반응_교환"),
     ('{"choices":[{"message":{"content":null}}]}', "반응_단순반응"),
     ('{"choices":[{"message":{"content":""}}]}', "반응_단순반응"),
     ('{"choices":[{"message":{}}]}', "반응_일반감상"), ('{"choices":[]}', "반응_일반감상"),
     ('{"choices":"abc"}', "반응_일반감상"), ("broken", "반응_일반감상"), (None, "반응_일반감상"),
     ('{"choices":[{"message":{"content":12}}]}', "반응_단순반응")],
)
def test_response_label(spark, response, want):
    row = spark.createDataFrame([(response,)], "r string").select(model_io.response_label(F.col("r")).alias("l"))
    assert row.first().l == want


PROMPT_DIGESTS = ("34894c6ba828ebeb", "0519e9c2d146183a")


# --- packages -------------------------------------------------------------------

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
PKG = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'


def book_parts(drift=""):
    return {
        "xl/workbook.xml": f'<?xml version="1.0" encoding="UTF-8"?><workbook {MAIN} {REL}><sheets>'
        '<sheet name="2026 list" sheetId="1" r:id="rId1"/><sheet name="IB" sheetId="2" state="hidden" r:id="rId2"/>'
        '</sheets><definedNames><definedName name="B" localSheetId="1"> IB!$A$1 </definedName></definedNames></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships {PKG}><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst {MAIN}><si><t>반응_제품반응</t></si>'
        '<si><r><t xml:space="preserve">사이즈 </t></r><r><t>궁금</t></r></si><si><t>주요 이슈</t></si></sst>',
        "xl/worksheets/sheet1.xml": f'<worksheet {MAIN} {REL}><dimension ref="A1:K9"/><sheetData><row r="5">'
        '<c r="G5" t="s"><v>0</v></c><c r="J5" t="s"><v>1</v></c><c r="K5" t="inlineStr"><is><t xml:space="preserve"> 원문 </t></is></c>'
        '<c r="L5"><f>1+1</f><v>2</v></c><c r="M5" t="s"><v>99</v></c><c r="N5" s="3"/></row></sheetData>'
        '<mergeCells><mergeCell ref="B1:C1"/><mergeCell ref="A1:A2"/></mergeCells>'
        '<hyperlinks><hyperlink ref="K5" r:id="rId9"/></hyperlinks></worksheet>',
        "xl/worksheets/_rels/sheet1.xml.rels": f'<Relationships {PKG}><Relationship Id="rId9" Target="https://example.com/post/5"/></Relationships>',
        "xl/worksheets/sheet2.xml": f'<worksheet {MAIN}><sheetData><row r="2"><c r="B2" t="str"><v>Voice Of Customer</v></c></row>'
        '<row r="4"><c r="F4" t="str"><v>https://example.com/post/5</v></c></row>'
        f'<row r="5"><c r="B5" t="s"><v>2</v></c><c r="C5" t="s"><v>0</v></c><c r="D5"><v>7{drift}</v></c></row></sheetData></worksheet>',
        "xl/media/image1.png": "png",
    }


def write_book(path, parts):
    with zipfile.ZipFile(path, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)


@pytest.fixture
def parts(spark, tmp_path):
    write_book(tmp_path / "a.xlsx", book_parts())
    return packages.read_parts(spark, str(tmp_path))


def test_package_members(parts):
    import hashlib

    rows = {r.part: r for r in parts.collect()}
    assert set(rows) == set(book_parts())
    assert rows["xl/media/image1.png"].sha256 == hashlib.sha256(b"png").hexdigest()


def test_catalogue_names_merges(parts):
    sheets = packages.sheet_catalogue(parts)
    got = [(r.sheet_idx, r.sheet_name, r.state, r.part) for r in sheets.orderBy("sheet_idx").collect()]
    assert got == [
        (0, "2026 list", "visible", "xl/worksheets/sheet1.xml"), (1, "IB", "hidden", "xl/worksheets/sheet2.xml")]
    name = packages.defined_names(parts).first()
    assert (name.name, name.local_sheet_id, name.text) == ("B", 1, "IB!$A$1")
    merges = {r.sheet_name: r.merges for r in packages.merges(parts, sheets).collect()}
    assert merges == {"2026 list": ["A1:A2", "B1:C1"], "IB": []}
    assert packages.dimensions(parts, sheets).first().ref == "A1:K9"


def test_cells_and_links(parts):
    sheets = packages.sheet_catalogue(parts)
    got = {(r.sheet_name, r.row_num, r.col_num): r for r in packages.cells(parts, sheets).collect()}
    assert got["2026 list", 5, 7].value == "반응_제품반응"
    assert got["2026 list", 5, 10].value == "사이즈 궁금"
    assert (got["2026 list", 5, 11].value, got["2026 list", 5, 11].hyperlink) == (" 원문 ", "https://example.com/post/5")
    assert got["2026 list", 5, 12].has_formula and got["2026 list", 5, 12].value == "2"
    assert ("2026 list", 5, 13) not in got and ("2026 list", 5, 14) not in got
    assert got["IB", 5, 4].value == "7"
    links = packages.hyperlinks(parts, sheets).collect()
    assert [(r.cell_ref, r.hyperlink) for r in links] == [("K5", "https://example.com/post/5")]


def test_grid_from_a_real_package_is_labelled_and_fanned_out(parts):
    cells = packages.cells(parts, packages.sheet_catalogue(parts))
    targets = grid.target_rows(cells)
    assert [(r.row_num, r.title, r.link) for r in targets.collect()] == [(5, "사이즈 궁금", "https://example.com/post/5")]
    updates = grid.winning_updates(jobs.rule_results(targets), grid.card_cells(cells))
    assert {(r.sheet_name, r.row_num, r.col_num, r.value) for r in updates.collect()} == {
        ("2026 list", 5, 7, "반응_문의"), ("IB", 5, 3, "반응_문의")}


def test_package_errors(spark, tmp_path):
    (tmp_path / "l").mkdir(), (tmp_path / "r").mkdir()
    changed = book_parts(drift="1")
    changed["xl/worksheets/sheet2.xml"] = changed["xl/worksheets/sheet2.xml"].replace('C5" t="s"><v>0', 'C5" t="str"><v>반응_문의')
    changed["xl/_rels/workbook.xml.rels"] += "\n"
    changed["xl/media/image2.png"] = "new"
    write_book(tmp_path / "l" / "a.xlsx", book_parts())
    write_book(tmp_path / "r" / "a.xlsx", changed)
    same_name = lambda df: df.withColumn("workbook", F.lit("a"))
    left, right = (jobs.snapshot(same_name(packages.read_parts(spark, str(tmp_path / s)))) for s in "lr")
    surface = contract.writable_bounds(spark.createDataFrame([("a", "IB", "C5")], "workbook string, sheet_name string, cell_range string"))
    writable = diff.Allowlist(include_writable=True)
    errors = {(r.error_kind, r.item) for r in jobs.package_errors(left, right, surface, writable).collect()}
    assert errors == {
        ("unexpected_added", "xl/media/image2.png"), ("unexpected_changed", "xl/_rels/workbook.xml.rels"),
        ("drift", "IB!D5"), ("media_count", "")}
    assert jobs.package_errors(left, left, surface, writable).count() == 0
    strict = {(r.error_kind, r.item) for r in jobs.package_errors(left, right, surface).collect()}
    assert ("unexpected_changed", "xl/worksheets/sheet2.xml") in strict
    free = diff.Allowlist(parts=("xl/_rels/workbook.xml.rels",), sheet_names=("IB",))
    left_over = {(r.error_kind, r.item) for r in jobs.package_errors(left, right, surface, free).collect()}
    assert left_over == errors - {("unexpected_changed", "xl/_rels/workbook.xml.rels")}


SHEET_CHANGES = [
    ("<f>1+1</f>", "<f>3-1</f>", ("drift", "2026 list!L5")), ('<c r="N5" s="3"/>', '<c r="N5" s="4"><v>1</v></c>', ("drift", "2026 list!N5")),
    ('<c r="L5">', '<c r="L5" s="2">', ("drift", "2026 list!L5")), ('<row r="5">', '<row r="5" ht="30">', ("sheet_drift", "2026 list!worksheet/sheetData[0]/row[5]")),
    ('ref="A1:K9"', 'ref="A1:K10"', ("sheet_drift", "2026 list!worksheet/dimension[0]")),
    ("<mergeCells>", '<dataValidations count="1"><dataValidation sqref="A1"/></dataValidations><mergeCells>', ("sheet_drift", "2026 list!worksheet/dataValidations[0]")),
    ("</worksheet>", '<ignoredErrors><ignoredError sqref="A1"/></ignoredErrors></worksheet>', ("sheet_drift", "2026 list!worksheet/ignoredErrors[0]")),
    ("<f>1+1</f>", '<f t="shared" ref="L5:L6" si="0">1+1</f>', ("drift", "2026 list!L5")),
    ('<c r="G5" t="s">', '<c r="G5" t="s" cm="1">', ("drift", "2026 list!G5")), ('<c r="J5" t="s">', '<c r="J5" ph="1" t="s">', ("drift", "2026 list!J5")),
    ('<c r="J5" t="s"><v>1</v>', '<c r="J5" t="s"><v>2</v>', ("drift", "2026 list!J5")), ('<c r="G5" t="s">', '<c r="G5">', ("drift", "2026 list!G5")),
    ('<c r="G5" t="s"><v>0</v></c>', "", ("drift", "2026 list!G5")), ("<v>2</v></c>", "<v>2</v></c>stray", ("drift", "2026 list!L5")),
    ('<dimension ref="A1:K9"/>', '<dimension ref="A1:K9"/><other:x xmlns:other="u"/>', ("sheet_drift", "2026 list!worksheet/{u}x[0]")),
    (" 원문 ", "원문", ("drift", "2026 list!K5")), ("</worksheet>", "", ("sheet_drift", "2026 list!unreadable")),
]


def stored_parts(spark, books):
    """Parts of ``books``: workbook name to its members."""
    rows = [(name, part, content.encode()) for name, parts in books.items() for part, content in parts.items()]
    return spark.createDataFrame(rows, "workbook string, part string, content binary").withColumn("sha256", F.sha2("content", 256))


def test_each_change_of_a_sheet_is_seen(spark):
    sheet, before, after = "xl/worksheets/sheet1.xml", {}, {}
    for k, (old, new, _) in enumerate(SHEET_CHANGES):
        before[f"w{k}"], after[f"w{k}"] = book_parts(), book_parts()
        assert old in after[f"w{k}"][sheet]
        after[f"w{k}"][sheet] = after[f"w{k}"][sheet].replace(old, new)
    left, right = jobs.snapshot(stored_parts(spark, before)), jobs.snapshot(stored_parts(spark, after))
    surface = spark.createDataFrame([(w, "2026 list", "G5") for w in before], "workbook string, sheet_name string, cell_range string")
    errors = jobs.package_errors(left, right, contract.writable_bounds(surface), diff.Allowlist(include_writable=True)).collect()
    for k, (_, _, want) in enumerate(SHEET_CHANGES):
        own = {(r.error_kind, r.item) for r in errors if r.workbook == f"w{k}"}
        assert want in own if want[1].endswith("unreadable") else own == {want}, SHEET_CHANGES[k]


SAME_SHEETS = [
    [('<c r="G5" t="s">', '<c t="s"  r="G5">'), ('<c r="N5" s="3"/>', '<c s="3" r="N5"></c>')], [("<mergeCells>", "<!-- <c r='A1'/> -->\n <mergeCells>")],
    [("<v>2</v>", "<v><![CDATA[2]]></v>"), (r"<f>1\+1</f>", "<f>1&#43;1</f>")], [("xmlns:r=", "xmlns:rel="), ("r:id=", "rel:id=")],
    [("xmlns=", "xmlns:x="), ("<(/?)([a-zA-Z])", r"<\1x:\2")], [('<c r="G5" t="s"><v>0</v>', '<c r="G5" t="inlineStr"><is><t>any <b/></t></is>')],
]


def test_the_same_sheet_written_otherwise_is_no_drift(spark):
    sheet, rows = book_parts()["xl/worksheets/sheet1.xml"], []
    for k, changes in enumerate(SAME_SHEETS):
        other = sheet
        for old, new in changes:
            assert re.search(old, other)
            other = re.sub(old, new, other)
        rows.append((f"w{k}", "S", other.encode(), sheet.encode()))
    table = spark.createDataFrame(rows, "workbook string, sheet_name string, other binary, sheet binary")
    surface = contract.writable_bounds(table.select("workbook", "sheet_name", F.lit("G5:G9").alias("cell_range")))
    side = lambda name: xml_tree.shred(table.withColumnRenamed(name, "content"))
    assert diff.tree_drift(side("sheet"), side("other"), surface).collect() == []


def test_moved_elements_are_a_drift_of_order(spark):
    sheet = book_parts()["xl/worksheets/sheet1.xml"]
    swapped = sheet.replace('<mergeCell ref="B1:C1"/>', "").replace('<mergeCell ref="A1:A2"/>', '<mergeCell ref="A1:A2"/><mergeCell ref="B1:C1"/>')
    head = '<dimension ref="A1:K9"/>'
    moved = sheet.replace(head, "").replace("<mergeCells>", head + "<mergeCells>")
    surface = contract.writable_bounds(spark.createDataFrame([], "workbook string, sheet_name string, cell_range string"))
    shredded = lambda text: xml_tree.shred(spark.createDataFrame([("a", "S", text.encode())], "workbook string, sheet_name string, content binary"))
    got = lambda text: {(r.path, r.change) for r in diff.tree_drift(shredded(sheet), shredded(text), surface).collect()}
    assert got(moved) == {("worksheet", "order")}
    assert got(swapped) == {("worksheet/mergeCells[0]/mergeCell[0]", "attributes"), ("worksheet/mergeCells[0]/mergeCell[1]", "attributes")}


def test_shredded_rows(spark):
    text = '<?xml version="1.0"?><a xmlns="u" xmlns:o="w"> <b k="2" j="1">x<c/>tail</b>\n<b/><o:b o:k="3">&amp;</o:b></a>'
    rows = xml_tree.shred(
        spark.createDataFrame([(7, text.encode()), (8, b"<a><b></a>"), (9, None), (10, b"")], "id int, content binary"), ["id"], {"b": "k"}, "b", ["c"]
    ).orderBy("id", "node").collect()
    got = [(r.path, r.parent, r.name, r.anchor, r.payload, [(a.name, a.value) for a in r.attributes], r.text, r.tail, r.children[:1], r.frame[:1]) for r in rows if r.id == 7]
    assert got == [
        ("a", "", "u}a", None, False, [], "", "", "3", "3"),
        ("a/b[2]", "a", "u}b", "2", False, [("j", "1"), ("k", "2")], "x", "", "1", ""),
        ("a/b[2]/c[0]", "a/b[2]", "u}c", "2", True, [], "", "tail", "", ""),
        ("a/b[0]", "a", "u}b", None, False, [], "", "", "", ""),
        ("a/{w}b[0]", "a", "w}b", None, False, [("w}k", "3")], "&", "", "", ""),
    ]
    assert {(r.id, r.path) for r in rows if r.id != 7} == {(8, "unreadable"), (10, "unreadable")}


def test_sheets_are_dealt_out_by_bytes(spark):
    rows = [(f"w{i}", "p", f"<a>{'<b/>' * 50}</a>".encode()) for i in range(20)]
    parts = spark.createDataFrame(rows, "workbook string, part string, content binary").coalesce(1)
    sheets = spark.createDataFrame([(f"w{i}", "p", "S") for i in range(20)], "workbook string, part string, sheet_name string")
    nodes = xml_tree.sheet_nodes(parts, sheets, task_bytes=len(rows[0][2]))
    assert nodes.groupBy("workbook").count().filter("count = 51").count() == 20
    per_task = nodes.groupBy(F.spark_partition_id()).agg(F.count_distinct("workbook").alias("n")).collect()
    assert len(per_task) > 8 and max(r.n for r in per_task) < 8


def test_damage_is_done_to_the_parts_at_hand(spark):
    from tagloom.plans import xml_parts

    rows = [("wb12", "xl/worksheets/sheet1.xml", b'<d ref="A1:K235"/>', "x"), ("wb3", "xl/workbook.xml", b"<workbook/>", "x")]
    parts = spark.createDataFrame(rows, "workbook string, part string, content binary, sha256 string")
    got = {r.workbook: bytes(r.content) for r in xml_parts.damaged_parts(spark, "/no/such/folder", parts).collect()}
    assert got == {"wb12": b'<d ref="A1:K999"/>', "wb3": b"<workbook/>"}


def test_unreadable_files_and_parts(spark, tmp_path):
    (tmp_path / "no.xlsx").write_bytes(b"no package")
    cut = book_parts()
    cut["xl/workbook.xml"] = cut["xl/workbook.xml"][:90]
    del cut["xl/sharedStrings.xml"]
    write_book(tmp_path / "cut.xlsx", cut)
    write_book(tmp_path / "bare.xlsx", {"xl/media/a.png": "x"})
    odd = book_parts()
    odd["xl/sharedStrings.xml"] = ('<?xml version="1.0" encoding="UTF-16"?>' + odd["xl/sharedStrings.xml"]).encode("utf-16")
    odd["xl/workbook.xml"] = odd["xl/workbook.xml"].replace("xmlns:r=", "xmlns:q=").replace("r:id", "q:id")
    write_book(tmp_path / "odd.xlsx", odd)
    parts = packages.read_parts(spark, str(tmp_path)).withColumn("workbook", F.regexp_extract("workbook", "([^/]*).xlsx$", 1))
    bad = {(r.workbook, r.part, r.reason) for r in packages.unreadable_parts(parts).collect()}
    assert bad == {("no", "", "not a package"), ("cut", "xl/workbook.xml", "not well-formed"),
                   ("bare", "xl/workbook.xml", "missing"), ("bare", "xl/_rels/workbook.xml.rels", "missing")}
    sheets = packages.sheet_catalogue(parts)
    assert {(r.workbook, r.sheet_name, r.part) for r in sheets.collect()} == {
        ("odd", "2026 list", "xl/worksheets/sheet1.xml"), ("odd", "IB", "xl/worksheets/sheet2.xml")}
    assert {r.value for r in packages.cells(parts, sheets).collect()} >= {"사이즈 궁금", "주요 이슈"}


def test_prompts_are_the_fixed_texts():
    import hashlib

    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()[:16]
    assert (digest(model_io.TITLE_PROMPT), digest(model_io.BODY_PROMPT)) == PROMPT_DIGESTS


# --- files and outputs -------------------------------------------------------------


def test_listings(spark, tmp_path):
    for folder, names in (("one", ["a.xlsx"]), ("two", ["b.xlsx", "c.xlsx"])):
        (tmp_path / folder).mkdir()
        for name in names:
            (tmp_path / folder / name).write_text(name)
    (tmp_path / "one" / "note.txt").write_text("x")
    listed = files.list_files(spark, str(tmp_path), "*.xlsx")
    single = files.single_inputs(listed).collect()
    assert [r.path.rsplit("/", 1)[1] for r in single] == ["a.xlsx"]
    assert {r.path.rsplit("/", 1)[1] for r in files.newest(listed).collect()} >= {"a.xlsx"}


@pytest.mark.parametrize(
    "kind, want", [("main", "output/260325_main_source.xlsx"), (" main ", "output/260325_main_source.xlsx"),
                   ("  ", None), ("..", None), ("a/b", None), ("a\\b", None)])
def test_dated_output(spark, kind, want):
    day = F.lit(datetime.date(2026, 3, 25))
    path = outputs.dated_output(F.lit("output"), F.lit("source.xlsx"), day, F.lit(kind))
    assert spark.range(1).select(path.alias("p")).first().p == want


def test_qa_output(spark):
    good = outputs.qa_output(F.lit("output"), F.lit("source.xlsx"), F.lit("spring"))
    assert spark.range(1).select(good.alias("p")).first().p == "output/qa/spring/source.xlsx"
    bad = outputs.qa_output(F.lit("output"), F.lit("source.xlsx"), F.col("id").cast("string") + F.lit("/"), strict=True)
    with pytest.raises(Exception, match="single safe path segment|CAST_INVALID"):
        spark.range(1).select(bad).collect()
    with pytest.raises(Exception, match="single safe path segment"):
        spark.createDataFrame([("..",)], "k string").select(
            outputs.qa_output(F.lit("o"), F.lit("s"), F.col("k"), strict=True)).collect()


def test_write_table_never_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1)], "workbook string, n int")
    outputs.write_table(df, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        outputs.write_table(df, path)
    assert spark.read.parquet(path).count() == 1


def test_contract_file(spark, tmp_path):
    from tagloom.operators.contract import normalise_contracts
    from tagloom.plans.catalog import contract_json

    text = json.loads(contract_json("x", ["h1", "h2"]))
    del text["family"]
    text["supported_workbook_family"]["workbook_xml_sha256"] = "h0"
    (tmp_path / "contract.json").write_text(json.dumps(text, indent=1, ensure_ascii=False))
    row = normalise_contracts(files.read_contracts(spark, str(tmp_path / "contract.json"))).first()
    assert row.family == "default" and row.sheet_count == 9
    assert row.hashes == ["h0", "h1", "h2"]
    assert len(row.state_variants) == 1 and len(row.state_variants[0]) == 9
    # The single value and the object of the list count, the string entry does not.
    assert [[e.key for e in v] for v in row.card_variants] == [[f"S{i}" for i in range(8)], ["S0"]]
    assert row.card_variants[1][0].value == []
    (tmp_path / "allow.json").write_text('{"allowed_changed_parts": ["a"]}')
    assert files.read_allowlist(spark, str(tmp_path / "allow.json")).first().allowed_changed_parts == ["a"]


def test_layout_of_two_cards(spark):
    rows = [("w", 1, "IB", 2, 2, "Voice Of Customer"), ("w", 1, "IB", 2, 8, "Voice Of Customer"),
            ("w", 1, "IB", 5, 13, "end"), ("w", 0, "2026 list", 5, 13, "stays")]
    cells = spark.createDataFrame(rows, "workbook string, sheet_idx int, sheet_name string, row_num int, col_num int, value string")
    moved = {(r.sheet_name, r.row_num, r.col_num) for r in layout.repaginate(cells).collect()}
    assert moved == {("IB", 2, 2), ("IB", 2, 9), ("IB", 5, 14), ("2026 list", 5, 13)}
    most = layout.sheet_max_columns(cells)
    areas = {r.sheet_name: r.print_area for r in layout.print_areas(most).collect()}
    assert areas == {"IB": "'IB'!$B$2:$O$35"}
    none = spark.createDataFrame([], "workbook string, sheet_name string, start_col int, end_col int, attrs string")
    pads = {(r.start_col, r.end_col) for r in layout.paged_columns(none, layout.paged_sheets(most)).collect()}
    assert pads == {(8, 8), (15, 15)}
    edges = layout.page_outlines(most)
    assert edges.count() == 2 * 34 * 6
    right = {r.col_num for r in edges.filter("right_edge").select("col_num").distinct().collect()}
    assert right == {7, 14}


def test_large_packages_by_ranges(spark, tmp_path):
    import os
    import random

    rnd = random.Random(2)
    write_book(tmp_path / "a.xlsx", book_parts())
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as book:
        for k in range(40):
            kind = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2)[k % 3 if k else 0]
            book.writestr(f"xl/media/{k}.bin", rnd.randbytes(300_000 + k), kind)
        book.writestr("empty", b"")
    (tmp_path / "no.xlsx").write_bytes(b"no package")
    spoilt = bytearray((tmp_path / "a.xlsx").read_bytes())
    at = spoilt.index(b"Voice Of Customer")
    spoilt[at] ^= 1
    (tmp_path / "spoilt.xlsx").write_bytes(bytes(spoilt))
    whole = packages.read_parts(spark, str(tmp_path))
    ranged = packages.read_large_parts(spark, str(tmp_path), task_bytes=1 << 20)
    key = lambda r: (os.path.basename(r.workbook), r.part, r.sha256)
    want = {key(r) for r in whole.collect()}
    bz = {("b.xlsx", f"xl/media/{k}.bin") for k in range(40) if k % 3 == 2}
    got = {key(r) for r in ranged.collect()}
    assert {k for k in got if k[:2] not in bz} == {k for k in want if k[:2] not in bz}
    assert {k[2] for k in got if k[:2] in bz} == {None}  # packed in a way that packages do not use
    assert ("no.xlsx", "", None) in got and ("spoilt.xlsx", "xl/worksheets/sheet2.xml", None) in got
    tasks = ranged.where("workbook LIKE '%b.xlsx'").select(F.spark_partition_id().alias("t"), F.length("content").alias("n")).groupBy("t").agg(F.sum("n").alias("n")).collect()
    assert len(tasks) > 6 and max(r.n or 0 for r in tasks) < 4_000_000


def test_publishing_shows_old_or_new_tables(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    table = lambda rows: spark.createDataFrame(rows, "workbook string, value int")
    now = lambda name="grid": {(r.workbook, r.value) for r in outputs.published(spark, folder, name).collect()}
    with pytest.raises(ValueError):
        now()
    outputs.publish({"grid": table([("a", 1), ("a", 2), ("b", 3)]), "summary": table([("a", 9)])}, folder)
    assert now() == {("a", 1), ("a", 2), ("b", 3)} and now("summary") == {("a", 9)}

    def lost(*_):
        raise KeyboardInterrupt("the driver is gone")

    with monkeypatch.context() as patch:
        patch.setattr(outputs, "_commit", lost)
        with pytest.raises(KeyboardInterrupt):
            outputs.publish({"grid": table([("a", 7)])}, folder)
    assert now() == {("a", 1), ("a", 2), ("b", 3)} and now("summary") == {("a", 9)}
    outputs.publish({"grid": table([("a", 7), ("c", 8)])}, folder)
    assert now() == {("a", 7), ("c", 8), ("b", 3)}
    with pytest.raises(ValueError):
        now("summary")  # the run replaced all of workbook a, and had no summary
    assert outputs.damaged_entries(spark, folder, "grid").count() == 0
    entry = outputs.manifest(spark, folder).where("workbook = 'b'").first()
    assert (entry.table_name, entry.n_rows) == ("grid", 1)
    table([("b", 4)]).write.mode("overwrite").parquet(f"{folder}/versions/{entry.version}/grid")
    assert [r.workbook for r in outputs.damaged_entries(spark, folder, "grid").collect()] == ["b"]
    # two runs that start from one manifest: the second to commit fails and changes nothing
    names = outputs._manifest_names(spark, folder)
    outputs.publish({"grid": table([("d", 1)])}, folder)
    monkeypatch.setattr(outputs, "_manifest_names", lambda *_: names)
    with pytest.raises(RuntimeError, match="another run"):
        outputs.publish({"grid": table([("e", 1)])}, folder)
    monkeypatch.undo()
    assert {w for w, _ in now()} == {"a", "b", "c", "d"}
