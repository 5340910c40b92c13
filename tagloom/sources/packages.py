"""Workbook packages: members, and the tables inside their XML parts.

Only the unzipping is Python, one file at a time.  Everything else works on
``parts(workbook, part, content, sha256)`` with Spark's own XML functions.
Elements and attributes are matched without their prefix and texts are decoded
as declared.  What cannot be read gives no rows here and one row in
``unreadable_parts``, which makes a workbook unsupported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.bind import evaluate_once
from tagloom.functions.refs import cell_ref, ref_column, ref_row
from tagloom.operators.lineage import cut_lineage
from tagloom.sources.charset import decode_page

CATALOGUE = "xl/workbook.xml"
CATALOGUE_RELS = "xl/_rels/workbook.xml.rels"
SHARED_STRINGS = "xl/sharedStrings.xml"

BROKEN = "_corrupt_record"
XML_OPTIONS = {
    "ignoreSurroundingSpaces": "false", "ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN,
}

SHEETS_XML = (
    "sheets struct<sheet: array<struct<_name: string, _state: string, `_id`: string>>>, "
    "definedNames struct<definedName: array<struct<_VALUE: string, _name: string, _localSheetId: string>>>, "
    "bookViews struct<workbookView: array<struct<_activeTab: string>>>"
)
RELS_XML = "Relationship array<struct<_Id: string, _Target: string, _Type: string>>"
STRINGS_XML = "si array<struct<t: string, r: array<struct<t: string>>>>"
SHEET_XML = (
    "dimension struct<_ref: string>, "
    "sheetData struct<row: array<struct<c: array<struct<_r: string, _t: string, _s: string, v: string, f: string, "
    "is: struct<t: string, r: array<struct<t: string>>>>>>>>, "
    "mergeCells struct<mergeCell: array<struct<_ref: string>>>, "
    "hyperlinks struct<hyperlink: array<struct<_ref: string, `_id`: string>>>"
)


def read_parts(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """Members of all packages under a folder: ``(workbook, part, content, sha256)``.

    A member that cannot be read has no content; a file that is no package is
    one such row without a part name.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(path)
        .select("path", "content")
    )

    def unzip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile
        import zlib

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as package:
                        for name in package.namelist():
                            try:
                                data = package.read(name)
                            except (zipfile.BadZipFile, OSError, ValueError, RuntimeError, NotImplementedError, zlib.error):
                                data = None
                            yield pd.DataFrame({"workbook": [path], "part": [name], "content": [data]})
                except (zipfile.BadZipFile, OSError, ValueError):
                    yield pd.DataFrame({"workbook": [path], "part": [""], "content": [None]})

    members = files.mapInPandas(unzip, "workbook string, part string, content binary")
    return members.withColumn("sha256", F.sha2("content", 256))


def read_large_parts(spark: SparkSession, path: str, pattern: str = "*.xlsx", task_bytes: int = 64 << 20) -> DataFrame:
    """The rows of ``read_parts`` for packages too large for one task, read by byte ranges.

    First only the central directory of each file is read; then members are
    dealt out over tasks of about ``task_bytes`` packed bytes, wherever their
    package lies, and each task seeks to its members.  No task holds more than
    one member at a time.  Files are opened through ``pyarrow.fs``, so their
    scheme must be one that it knows.
    """
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(path).select("path")
    )
    spots = listed.mapInPandas(
        _package_directory, "workbook string, part string, at long, packed long, size long, method int, crc long, hidden boolean"
    )
    spots = cut_lineage(spots)
    packed = spots.agg(F.sum("packed")).first()[0] or 0
    dealt = spots.repartition(max(1, -(-packed // task_bytes)), F.xxhash64("workbook", "part", "at"))
    members = dealt.mapInPandas(_package_members, "workbook string, part string, content binary")
    return members.withColumn("sha256", F.sha2("content", 256))


def _opened(path: str):
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def _package_directory(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Where the members of each package lie, from its central directory alone."""
    import zipfile

    names = ["workbook", "part", "at", "packed", "size", "method", "crc", "hidden"]
    for batch in batches:
        for path in batch["path"]:
            try:
                with _opened(path) as file, zipfile.ZipFile(file) as package:
                    rows = [
                        (path, i.filename, i.header_offset, i.compress_size, i.file_size, i.compress_type, i.CRC, bool(i.flag_bits & 1))
                        for i in package.infolist()
                    ]
            except (zipfile.BadZipFile, OSError, ValueError):
                rows = [(path, "", -1, 0, 0, 0, 0, False)]
            for at in range(0, len(rows), 10_000):
                yield pd.DataFrame(rows[at : at + 10_000], columns=names)


def _package_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each member, read where the directory says; what does not unpack to its checksum has no content."""
    import struct
    import zlib

    def content(file, spot) -> bytes | None:
        if spot.hidden or spot.method not in (0, 8):
            return None
        file.seek(spot.at)
        head = file.read(30)
        if len(head) < 30 or head[:4] != b"PK\x03\x04":
            return None
        file.seek(spot.at + 30 + sum(struct.unpack("<HH", head[26:30])))
        data = file.read(spot.packed)
        if spot.method == 8:
            try:
                data = zlib.decompressobj(-15).decompress(data, spot.size + 1)
            except zlib.error:
                return None
        return data if len(data) == spot.size and zlib.crc32(data) == spot.crc else None

    for batch in batches:
        for path, spots in batch.groupby("workbook", sort=False):
            lost = spots[spots["at"] < 0]
            if len(lost):
                yield pd.DataFrame({"workbook": [path], "part": [""], "content": [None]})
                continue
            with _opened(path) as file:
                for spot in spots.itertuples():
                    yield pd.DataFrame({"workbook": [path], "part": [spot.part], "content": [content(file, spot)]})


def file_hashes(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """Hash of each whole file: ``(workbook, file_sha256)``."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true").load(path)
    )
    return files.select(F.col("path").alias("workbook"), F.sha2("content", 256).alias("file_sha256"))


def part_text(content: Column) -> Column:
    """A part as text: by its byte order mark, else its XML declaration, else as UTF-8."""
    mark = F.hex(F.substring(content, 1, 2))
    head = F.decode(F.substring(content, 1, 200), "ISO-8859-1")
    named = F.regexp_extract(head, "^\\s*<\\?xml[^>]*encoding=[\"']([A-Za-z0-9._-]+)[\"']", 1)
    declared = F.when(mark.isin("FEFF", "FFFE"), F.lit("utf-16")).when(named != "", named)
    return F.regexp_replace(decode_page(content, declared), "^\\x{FEFF}", "")


def _tree(content: Column, schema: str) -> Column:
    return F.from_xml(part_text(content), f"{schema}, {BROKEN} string", XML_OPTIONS)


def _is_broken(tree: Column) -> Column:
    return tree.isNull() | tree.getField(BROKEN).isNotNull()


def _parsed(parts: DataFrame, name: Column, schema: str) -> DataFrame:
    """Parse the parts that ``name`` picks; the filter runs before any parsing.  Broken parts are left out."""
    picked = parts.filter(name & F.col("content").isNotNull())
    trees = evaluate_once(picked.select("workbook", "part", "content"), "x", _tree(F.col("content"), schema)).drop("content")
    return trees.filter(~_is_broken(F.col("x")))


def unreadable_parts(parts: DataFrame) -> DataFrame:
    """Packages and XML parts that cannot be read: ``(workbook, part, reason)``.

    Every XML part that a scan reads is parsed here once more, each by the
    schema of its scan.  A workbook without a catalogue or without its
    relationships is listed as well.
    """
    part = F.col("part")
    lost = parts.filter(F.col("content").isNull()).select(
        "workbook", "part", F.when(part == "", F.lit("not a package")).otherwise(F.lit("member cannot be read")).alias("reason")
    )
    sheet = part.rlike("^xl/worksheets/[^/]*\\.xml$")
    found = lost
    for picked, schema in (
        (part == CATALOGUE, SHEETS_XML), (part.rlike("\\.rels$"), RELS_XML), (part == SHARED_STRINGS, STRINGS_XML), (sheet, SHEET_XML),
    ):
        chosen = parts.filter(picked & F.col("content").isNotNull()).select("workbook", "part", "content")
        trees = evaluate_once(chosen, "x", _tree(F.col("content"), schema))
        found = found.union(trees.filter(_is_broken(F.col("x"))).select("workbook", "part", F.lit("not well-formed")))
    needed = (CATALOGUE, CATALOGUE_RELS)
    has = parts.groupBy("workbook").agg(
        F.count_if(part == "").alias("lost"), *[F.count_if(part == name).alias(f"n{i}") for i, name in enumerate(needed)]
    ).filter("lost = 0")
    for i, name in enumerate(needed):
        found = found.union(has.filter(F.col(f"n{i}") == 0).select("workbook", F.lit(name), F.lit("missing")))
    return found


def _full_path(target: Column) -> Column:
    bare = F.regexp_replace(target, "^/+", "")
    return F.when(bare.startswith("xl/"), bare).otherwise(F.concat(F.lit("xl/"), bare))


def relationships(parts: DataFrame, name: Column) -> DataFrame:
    """``(workbook, part, rel_id, target)`` of the relationship parts that ``name`` picks."""
    rels = _parsed(parts, name, RELS_XML)
    return rels.select("workbook", "part", F.explode("x.Relationship").alias("rel")).select(
        "workbook", "part", F.col("rel._Id").alias("rel_id"), F.col("rel._Target").alias("target")
    ).filter("rel_id != '' AND target != ''")


def sheet_catalogue(parts: DataFrame) -> DataFrame:
    """Sheets in order: ``(workbook, sheet_idx, sheet_name, state, part)``.

    ``part`` is NULL when the catalogue points to no relationship.
    """
    book = _parsed(parts, F.col("part") == CATALOGUE, SHEETS_XML)
    listed = book.select("workbook", F.posexplode("x.sheets.sheet").alias("sheet_idx", "s")).select(
        "workbook", "sheet_idx",
        F.col("s._name").alias("sheet_name"),
        F.coalesce("s._state", F.lit("visible")).alias("state"),
        F.col("s._id").alias("rel_id"),
    )
    rels = relationships(parts, F.col("part") == CATALOGUE_RELS).select(
        "workbook", "rel_id", _full_path(F.col("target")).alias("part")
    )
    return listed.join(rels, ["workbook", "rel_id"], "left").select(
        "workbook", "sheet_idx", "sheet_name", "state", "part"
    )


def _item_text(item: Column) -> Column:
    """Text of a string item: its plain text, else its runs put together."""
    runs = F.array_join(F.transform(item["r"], lambda r: F.coalesce(r["t"], F.lit(""))), "")
    return F.coalesce(item["t"], runs, F.lit(""))


def shared_strings(parts: DataFrame) -> DataFrame:
    """``(workbook, idx, text)``."""
    items = _parsed(parts, F.col("part") == SHARED_STRINGS, STRINGS_XML)
    return items.select("workbook", F.posexplode("x.si").alias("idx", "si")).select(
        "workbook", "idx", _item_text(F.col("si")).alias("text")
    )


def _sheet_parts(parts: DataFrame, sheets: DataFrame) -> DataFrame:
    """Parsed sheet parts; only parts that the catalogue names are parsed."""
    wanted = sheets.filter("sheet_name != '' AND part IS NOT NULL").select("workbook", "part", "sheet_idx", "sheet_name")
    chosen = parts.filter(F.col("content").isNotNull()).select("workbook", "part", "content").join(wanted, ["workbook", "part"])
    trees = evaluate_once(chosen, "x", _tree(F.col("content"), SHEET_XML)).drop("content")
    return trees.filter(~_is_broken(F.col("x")))


def _link_targets(parts: DataFrame) -> DataFrame:
    """``(workbook, rels, rel_id, hyperlink)`` of all relationship parts but the catalogue's."""
    targets = relationships(parts, F.col("part").rlike("/_rels/[^/]+\\.rels$") & (F.col("part") != CATALOGUE_RELS))
    return targets.select("workbook", F.col("part").alias("rels"), "rel_id", F.col("target").alias("hyperlink"))


def _rels_of(part: Column) -> Column:
    return F.regexp_replace(part, "^(.*)/([^/]+)$", "$1/_rels/$2.rels")


def hyperlinks(parts: DataFrame, sheets: DataFrame) -> DataFrame:
    """``(workbook, sheet_name, cell_ref, hyperlink)``."""
    refs = _sheet_parts(parts, sheets).select(
        "workbook", "part", "sheet_name", F.explode("x.hyperlinks.hyperlink").alias("h")
    ).select(
        "workbook", "sheet_name", F.col("h._ref").alias("cell_ref"), F.col("h._id").alias("rel_id"),
        _rels_of(F.col("part")).alias("rels"),
    )
    return refs.join(_link_targets(parts), ["workbook", "rels", "rel_id"]).select(
        "workbook", "sheet_name", "cell_ref", "hyperlink"
    )


def cells(parts: DataFrame, sheets: DataFrame) -> DataFrame:
    """The grid: one row per cell that holds a value, a formula or a link.

    A shared string beyond the table gives NULL; a cell without any value or
    formula is left out unless a hyperlink lies on it.  Each sheet is parsed
    once: its cells and its links leave the tree together and meet by
    reference.
    """
    tree = F.col("x")
    none = lambda kind: F.lit(None).cast(kind)
    entry = lambda ref, type_, style, raw, inline, formula, link: F.struct(
        ref.alias("cell_ref"), type_.alias("cell_type"), style.alias("style"), raw.alias("raw"), inline.alias("inline"),
        formula.alias("formula"), link.alias("rel_id"),
    )
    text = none("string")
    rows = F.coalesce(tree["sheetData"]["row"]["c"], F.array())
    held = F.transform(
        F.flatten(F.filter(rows, lambda r: r.isNotNull())),
        lambda c: entry(c["_r"], c["_t"], c["_s"], c["v"], F.when(c["is"].isNotNull(), _item_text(c["is"])), c["f"], text),
    )
    links = F.transform(
        F.coalesce(tree["hyperlinks"]["hyperlink"], F.array()),
        lambda h: entry(h["_ref"], text, text, text, text, text, h["_id"]),
    )
    loose = (
        _sheet_parts(parts, sheets)
        .select("workbook", "sheet_idx", "sheet_name", _rels_of(F.col("part")).alias("rels"), F.inline(F.concat(held, links)))
        .filter("cell_ref != ''")
    )
    keyed = loose.groupBy("workbook", "sheet_idx", "sheet_name", "rels", "cell_ref").agg(
        *[F.max(c).alias(c) for c in ("cell_type", "style", "raw", "inline", "formula", "rel_id")]
    ).withColumn("has_formula", F.col("formula").isNotNull())
    shared = F.col("cell_type") == "s"
    looked_up = keyed.withColumn("idx", F.when(shared, F.col("raw").try_cast("int"))).join(
        shared_strings(parts), ["workbook", "idx"], "left"
    )
    value = (
        F.when(F.col("cell_type") == "inlineStr", F.coalesce("inline", F.lit(""))).when(shared, F.col("text")).otherwise(F.col("raw"))
    )
    grid = looked_up.withColumn("value", value).join(_link_targets(parts), ["workbook", "rels", "rel_id"], "left")
    return grid.filter("value IS NOT NULL OR has_formula OR hyperlink IS NOT NULL").select(
        "workbook", "sheet_idx", "sheet_name", ref_row(F.col("cell_ref")).alias("row_num"),
        ref_column(F.col("cell_ref")).alias("col_num"), "value", "hyperlink", "cell_type", "has_formula", "formula", "style",
    )


def defined_names(parts: DataFrame) -> DataFrame:
    """``(workbook, name, local_sheet_id, text)``."""
    book = _parsed(parts, F.col("part") == CATALOGUE, SHEETS_XML)
    return book.select("workbook", F.explode("x.definedNames.definedName").alias("d")).select(
        "workbook",
        F.coalesce("d._name", F.lit("")).alias("name"),
        F.col("d._localSheetId").try_cast("int").alias("local_sheet_id"),
        F.trim(F.coalesce("d._VALUE", F.lit(""))).alias("text"),
    )


def merges(parts: DataFrame, sheets: DataFrame) -> DataFrame:
    """``(workbook, sheet_name, merges)``: sorted merge ranges, empty when a sheet has none."""
    refs = F.filter(F.col("x.mergeCells.mergeCell._ref"), lambda r: r != "")
    return _sheet_parts(parts, sheets).select(
        "workbook", "sheet_name",
        F.array_sort(F.coalesce(refs, F.array().cast("array<string>"))).alias("merges"),
    )


def dimensions(parts: DataFrame, sheets: DataFrame) -> DataFrame:
    """Declared dimension per sheet: ``(workbook, sheet_name, ref)``."""
    return _sheet_parts(parts, sheets).select(
        "workbook", "sheet_name", F.col("x.dimension._ref").alias("ref")
    ).filter("ref != ''")


def with_cell_ref(grid: DataFrame) -> DataFrame:
    return grid.withColumn("cell_ref", cell_ref(F.col("row_num"), F.col("col_num")))
