"""Any XML part as rows, one for each element, so that trees can be compared by joins."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.bind import evaluate_once
from tagloom.operators.lineage import Stage, cut_lineage
from tagloom.sources.packages import part_text

UNREADABLE = "unreadable"
ROWS = 8192
TASK_BYTES = 4 << 20  # of parts that one task reads, but for a larger part
ENTRY = pa.struct([("name", pa.string()), ("value", pa.string())])
KINDS = {
    "path": pa.string(), "parent": pa.string(), "node": pa.int64(), "name": pa.string(), "anchor": pa.string(), "payload": pa.bool_(),
    "attributes": pa.list_(ENTRY), "text": pa.string(), "tail": pa.string(), "children": pa.string(), "frame": pa.string(),
}
SHAPE = (
    "path string, parent string, node long, name string, anchor string, payload boolean, "
    "attributes array<struct<name: string, value: string>>, text string, tail string, children string, frame string"
)


class _Listed:
    """Number and digest of the places of children, in order."""

    def __init__(self):
        self.count, self.digest = 0, hashlib.md5()

    def with_(self, spot: str) -> _Listed:
        self.count += 1
        self.digest.update(f"{spot}\n".encode("utf-8", "surrogatepass"))
        return self

    def shown(self) -> str:
        return f"{self.count}:{self.digest.hexdigest()}"


@dataclass
class _Open:
    """An element whose end has not come, or whose tail is still being read."""

    path: str
    parent: str
    node: int
    name: str
    anchor: str | None
    payload: bool
    attributes: list[dict[str, str]]
    text: list[str] = field(default_factory=list)
    tail: list[str] = field(default_factory=list)
    times: dict[str, int] = field(default_factory=dict)
    listed: _Listed | None = None
    framed: _Listed | None = None
    last: _Open | None = None

    def row(self) -> tuple:
        solid = lambda parts: t if (t := "".join(parts)).strip() else ""
        return (
            self.path, self.parent, self.node, self.name, self.anchor, self.payload, self.attributes, solid(self.text), solid(self.tail),
            self.listed.shown() if self.listed else "", self.framed.shown() if self.framed else "",
        )


class _Shredder:
    """Turns one part into rows while it is parsed; holds the open elements only."""

    def __init__(self, keys: Mapping[str, str], anchor: str, payload: Sequence[str]):
        self.keys, self.anchor, self.payload = keys, anchor, set(payload)
        self.rows: list[tuple] = []
        self.stack: list[_Open] = []
        self.count, self.space = 0, ""

    def start(self, name: str, attributes: dict[str, str]) -> None:
        space, _, local = name.rpartition("}")
        if not self.stack:
            self.space = space
        shown = local if space == self.space else f"{{{space}}}{local}"
        above = self.stack[-1] if self.stack else None
        key = attributes.get(self.keys[shown]) if shown in self.keys else None
        spot = shown if key is None else f"{shown}[{key}]"
        times = 0
        if above:
            times = above.times.get(spot, 0)
            above.times[spot] = times + 1
            if above.last:
                self.rows.append(above.last.row())
        if above and key is None:
            spot = f"{shown}[{times}]"
        elif times:
            spot = f"{spot}#{times}"
        anchor = above.anchor if above else None
        payload = bool(above and above.payload)
        if above and above.anchor is not None and above.name == f"{self.space}}}{self.anchor}":
            payload = shown in self.payload
        if shown == self.anchor and key is not None:
            anchor = key.upper()
        if above:
            above.listed = (above.listed or _Listed()).with_(spot)
            if shown not in self.payload:
                above.framed = (above.framed or _Listed()).with_(spot)
        entries = [{"name": n, "value": v} for n, v in sorted(attributes.items())]
        own = _Open(f"{above.path}/{spot}" if above else spot, above.path if above else "", self.count, f"{self.space}}}{local}" if space == self.space else name, anchor, payload, entries)
        self.count += 1
        if above:
            above.last = own
        self.stack.append(own)

    def end(self, _name: str) -> None:
        own = self.stack.pop()
        if own.last:
            self.rows.append(own.last.row())
            own.last = None
        if not self.stack:
            self.rows.append(own.row())

    def data(self, text: str) -> None:
        if self.stack:
            own = self.stack[-1]
            (own.last.tail if own.last else own.text).append(text)


def shredded(text: str, keys: Mapping[str, str], anchor: str, payload: Sequence[str]) -> Iterator[list[tuple]]:
    """Rows of one document in pieces; one that is not well-formed ends in a row that stands for its whole text."""
    data = text.encode("utf-8", "surrogatepass")
    work = _Shredder(keys, anchor, payload)
    parser = expat.ParserCreate("utf-8", "}")
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = work.start, work.end, work.data
    parser.buffer_text = True
    try:
        for at in range(0, len(data), 1 << 20):
            parser.Parse(data[at : at + (1 << 20)], False)
            if len(work.rows) >= ROWS:
                yield work.rows
                work.rows = []
        parser.Parse(b"", True)
    except expat.ExpatError:
        work.rows.append((UNREADABLE, "", work.count, "", None, False, [], hashlib.md5(data).hexdigest(), "", "", ""))
    yield work.rows


def shred(
    parts: DataFrame, columns: Sequence[str] = ("workbook", "sheet_name"), keys: Mapping[str, str] | None = None,
    anchor: str = "c", payload: Sequence[str] = ("v", "is"),
) -> DataFrame:
    """All elements of ``parts(*columns, content)``: one row each, whatever their names.

    * ``path``: names from the root, each with its place among siblings of that
      name (``worksheet/sheetData[0]/row[5]/c[G5]``); elements named in ``keys``
      stand by that attribute's value instead.  ``parent``: the path above;
      ``node``: the place in document order.
    * ``name`` with namespace, ``attributes`` sorted by name, ``text`` and the
      ``tail`` after the element; those of white space only are empty.
    * ``children``: number and digest of the ordered children's places;
      ``frame``: the same without those named in ``payload``.
    * ``anchor``: the key of the nearest element named ``anchor``, in upper
      case; ``payload``: whether the element lies in a payload of one.

    Attribute order, namespace prefixes, entities, CDATA, comments and the form
    of empty elements make no difference.  A part that is not well-formed gives
    the elements before its fault and a row ``unreadable`` with its digest.  Parts are dealt out over tasks; one part is one task's work, read
    as a stream of rows.
    """
    keys = {"row": "r", "c": "r"} if keys is None else keys
    columns = list(columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for rows in shredded(batch.column(len(columns))[i].as_py(), keys, anchor, payload):
                    values = list(zip(*rows, strict=True)) if rows else [[]] * len(KINDS)
                    same = [batch.column(k).take(pa.array([i] * len(rows), pa.int64())) for k in range(len(columns))]
                    yield pa.RecordBatch.from_arrays(
                        [*same, *(pa.array(v, kind) for v, kind in zip(values, KINDS.values(), strict=True))], [*columns, *KINDS]
                    )

    read = evaluate_once(parts.filter("content IS NOT NULL").select(*columns, "content"), "text", part_text(F.col("content"))).drop("content")
    head = ", ".join(f"`{c}` {parts.schema[c].dataType.simpleString()}" for c in columns)
    return read.select(*columns, F.coalesce("text", F.lit("")).alias("text")).mapInArrow(work, f"{head}, {SHAPE}")


def dealt_by_bytes(parts: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``parts`` over as many tasks as their bytes need.

    Python workers get rows in batches that end with a task's rows, so that the
    text they hold at once does not grow with the table.
    """
    size = parts.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    return parts.repartition(max(1, -(-size // task_bytes)), F.xxhash64(*parts.columns))


def sheet_nodes(parts: DataFrame, sheets: DataFrame, stage: Stage = cut_lineage, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The elements of all sheet parts that the catalogue names, by ``workbook`` and ``sheet_name``."""
    wanted = sheets.filter("sheet_name != '' AND part IS NOT NULL").select("workbook", "part", "sheet_name")
    chosen = stage(parts.filter("content IS NOT NULL").select("workbook", "part", "content").join(wanted, ["workbook", "part"]))
    return shred(dealt_by_bytes(chosen, task_bytes))
