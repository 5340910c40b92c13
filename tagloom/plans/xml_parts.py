"""Package parts built by Spark from the posts, so the XML scans have whole tables to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.plans.views import view

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RELS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
PACKAGE = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'


def _escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _ordered(order: str, xml: Column) -> Column:
    """Fragments of one workbook put together in order; a workbook has 40 posts."""
    pieces = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), xml.alias("xml"))))
    return F.array_join(F.transform(pieces, lambda p: p["xml"]), "")


def _part(rows: DataFrame, part: str, head: str, body: Column, tail: str) -> DataFrame:
    text = F.concat(F.lit(head), body, F.lit(tail))
    return rows.groupBy("workbook").agg(text.alias("text")).select(
        "workbook", F.lit(part).alias("part"), F.encode("text", "UTF-8").alias("content")
    )


def package_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = view(spark, sf_dir, "post_list")
    sheets = view(spark, sf_dir, "sheets")
    slot = F.col("doc_id") % 40
    title, link = _escaped(F.col("title")), _escaped(F.col("link"))
    hidden = F.when(F.col("state") == "hidden", F.lit(' state="hidden"')).otherwise("")

    catalogue = _part(
        sheets, "xl/workbook.xml", f"<workbook {MAIN} {RELS}><sheets>",
        _ordered("sheet_idx", F.concat(
            F.lit('<sheet name="'), F.col("sheet_name"), F.lit('"'), hidden,
            F.format_string(' sheetId="%d" r:id="rId%d"/>', F.col("sheet_idx") + 1, F.col("sheet_idx") + 1),
        )),
        '</sheets><definedNames><definedName name="Total"> SUM(A:A) </definedName>'
        '<definedName name="_xlnm.Print_Area" localSheetId="1">S0!$B$2</definedName></definedNames></workbook>',
    )
    catalogue_rels = _part(
        sheets, "xl/_rels/workbook.xml.rels", f"<Relationships {PACKAGE}>",
        _ordered("sheet_idx", F.concat(
            F.format_string('<Relationship Id="rId%d" Type="sheet" Target="', F.col("sheet_idx") + 1),
            F.when(F.col("sheet_idx") % 2 == 0, F.regexp_replace("part", "^xl/", "")).otherwise(
                F.concat(F.lit("/"), "part")
            ),
            F.lit('"/>'),
        )),
        "</Relationships>",
    )
    half = F.floor(F.length("title") / 2).cast("int")
    rich = F.concat(
        F.lit('<si><r><t xml:space="preserve">'), _escaped(F.substr(F.col("title"), F.lit(1), half)),
        F.lit('</t></r><r><rPr/><t xml:space="preserve">'), _escaped(F.substr(F.col("title"), half + 1)),
        F.lit("</t></r></si>"),
    )
    plain = F.concat(F.lit('<si><t xml:space="preserve">'), title, F.lit("</t></si>"))
    strings = _part(
        posts, "xl/sharedStrings.xml", f"<sst {MAIN}>",
        _ordered("doc_id", F.when(slot % 5 == 0, rich).otherwise(plain)), "</sst>",
    )
    first_slot = F.when(slot % 13 == 7, 9999).otherwise(slot)
    row = F.concat(
        F.format_string('<row r="%d"><c r="G%d" t="inlineStr"><is><t>', F.col("row_num"), F.col("row_num")),
        F.col("marker"), F.lit("</t></is></c>"),
        F.when(slot % 6 == 2, F.format_string('<c r="H%d"><f>1+1</f><v>2</v></c>', F.col("row_num"))).otherwise(
            F.format_string('<c r="H%d" s="1"/>', F.col("row_num"))
        ),
        F.format_string('<c r="J%d" t="s"><v>%d</v></c>', F.col("row_num"), first_slot),
        F.when(F.col("link") != "", F.concat(F.format_string('<c r="K%d" t="str"><v>', F.col("row_num")), link, F.lit("</v></c>"))).otherwise(""),
        F.lit("</row>"),
    )
    linked = F.col("link") != ""
    merge = F.format_string('<mergeCell ref="A%d:B%d"/>', F.col("row_num"), F.col("row_num"))
    hyper = F.when(linked, F.format_string('<hyperlink ref="K%d" r:id="rId%d"/>', F.col("row_num"), slot + 1)).otherwise("")
    body = F.concat(
        F.lit("<sheetData>"), _ordered("row_num", row), F.lit("</sheetData><mergeCells>"),
        _ordered("row_num", F.when(slot % 3 == 0, merge).otherwise("")), F.lit("</mergeCells><hyperlinks>"),
        _ordered("row_num", hyper), F.lit("</hyperlinks>"),
    )
    sheet = _part(
        posts, "xl/worksheets/sheet1.xml", f'<worksheet {MAIN} {RELS}><dimension ref="A1:K235"/>', body, "</worksheet>"
    )
    rel = F.when(linked, F.concat(
        F.format_string('<Relationship Id="rId%d" Type="hyperlink" Target="', slot + 1), link, F.lit('"/>')
    )).otherwise("")
    sheet_rels = _part(
        posts, "xl/worksheets/_rels/sheet1.xml.rels", f"<Relationships {PACKAGE}>", _ordered("row_num", rel), "</Relationships>"
    )
    parts = catalogue
    for more in (catalogue_rels, strings, sheet, sheet_rels):
        parts = parts.unionByName(more)
    # Every third workbook has prefixed strings, every fourth a sheet in UTF-16.
    number = F.substring("workbook", 3, 9).cast("int")
    text = F.decode("content", "UTF-8")
    prefixed = F.regexp_replace(F.regexp_replace(text, "<(/?)([A-Za-z])", "<$1x:$2"), "xmlns=", "xmlns:x=")
    is_sheet = F.col("part") == "xl/worksheets/sheet1.xml"
    content = (
        F.when((number % 3 == 0) & (F.col("part") == "xl/sharedStrings.xml"), F.encode(prefixed, "UTF-8"))
        .when((number % 4 == 1) & is_sheet, F.encode(F.concat(F.lit('<?xml version="1.0" encoding="UTF-16"?>'), text), "UTF-16"))
        .otherwise(F.col("content"))
    )
    return parts.withColumn("content", content).withColumn("sha256", F.sha2("content", 256))


def damaged_parts(spark: SparkSession, sf_dir: str, parts: DataFrame | None = None) -> DataFrame:
    """The same parts as another tool or a poor copy would leave them; ``parts`` are those of ``package_parts``, if they are at hand.

    Some are cut off or lost; sheets in UTF-8 have other settings, elements,
    attributes, formulas and values, or are only written in another way.
    """
    number, part = F.substring("workbook", 3, 9).cast("int"), F.col("part")
    whole = F.col("content")
    cut = F.substring(whole, 1, 60)
    sheet = (part == "xl/worksheets/sheet1.xml") & (number % 4 != 1)

    def swap(text: Column, when: Column, old: str, new: str) -> Column:
        # mentions the text once, so that a chain of swaps stays a chain
        return F.regexp_replace(text, F.when(when, F.lit(old)).otherwise("(?!)"), F.lit(new))

    text = F.decode(whole, "UTF-8")
    text = swap(text, number % 4 == 0, 'ref="A1:K235"', 'ref="A1:K999"')
    text = swap(text, number % 4 == 2, '<row r="7"', '<row ht="40" r="7"')
    text = swap(text, number % 7 == 0, '(<c r="J7" t="s"><v>)[0-9]+', "$1777")
    text = swap(text, number % 7 == 1, "</worksheet>", '<ignoredErrors><ignoredError sqref="A1"/></ignoredErrors></worksheet>')
    text = swap(text, number % 7 == 2, "<f>", '<f t="shared" ref="H5:H6" si="0">')
    text = swap(text, number % 7 == 3, '<c r="G7"', '<c cm="1" r="G7"')
    # the same tree, written in other ways
    text = swap(text, number % 7 == 4, '<c r="(H[0-9]+)" s="1"/>', '<c s="1"\n r="$1"></c>')
    text = swap(swap(text, number % 7 == 4, "<(/?)([A-Za-z])", "<$1x:$2"), number % 7 == 4, "xmlns=", "xmlns:x=")
    text = swap(text, number % 7 == 5, "<mergeCells>", '<!-- <c r="Z9"/> -->\n<mergeCells>')
    # an approved value
    text = swap(text, number % 7 == 6, "<is><t>[^<]*</t></is>", "<is><t>new</t></is>")
    content = (
        F.when((number % 5 == 1) & (part == "xl/workbook.xml"), cut)
        .when((number % 5 == 2) & (part == "xl/sharedStrings.xml"), cut)
        .when((number % 5 == 3) & (part == "xl/worksheets/sheet1.xml"), F.lit(None).cast("binary"))
        .when(sheet, F.encode(text, "UTF-8"))
        .otherwise(whole)
    )
    parts = package_parts(spark, sf_dir) if parts is None else parts
    return parts.withColumn("content", content).withColumn("sha256", F.sha2("content", 256))
