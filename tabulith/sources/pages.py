"""A reader of page layouts: files of any format, read by a parser that is given by name.

``spark.read.format("layout").load(folder)`` gives a row a page of all files in a folder, with its words, blocks,
segments and drawings as lists; with ``.option("relation", "word")`` one relation's rows. Small files share a
partition. ``read_layout`` parses all files once and splits the pages by columns. The option
``parser`` names a function as "module:function"; it takes a file's bytes and yields (relation, row)
with rows as dictionaries without doc_id, which is the file's name without its ending. The parser used
otherwise reads JSON; one for PDF files needs a library that is not among this project's.
"""

from __future__ import annotations

import glob
import importlib
import json
import os
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tabulith.storage import importable, stored

_BOX = "x0 double, y0 double, x1 double, y1 double"
RELATIONS = {
    "page": "doc_id string, page_no long, width double, height double",
    "block": f"doc_id string, page_no long, block_seq long, {_BOX}, text string, block_type long",
    "word": f"doc_id string, page_no long, word_seq long, {_BOX}, text string",
    "drawing": f"doc_id string, page_no long, drawing_seq long, {_BOX}",
    "segment": "doc_id string, page_no long, drawing_seq long, item_seq long, kind string, p1x double, p1y double, p2x double, p2y double, dx0 double, dy0 double, dx1 double, dy1 double",
}


def json_pages(data: bytes) -> Iterator[tuple[str, dict]]:
    """Pages of {"pages": [{"width", "height", "words", "blocks", "drawings"}]}.

    A word is [x0, y0, x1, y1, text], a block the same with its type at the end (0 is text), a drawing
    {"rect": [x0, y0, x1, y1], "items": [["l", [x, y], [x, y]], ...]}; items that are no lines are skipped."""
    box = lambda b: dict(zip(("x0", "y0", "x1", "y1"), map(float, b[:4]), strict=True))
    for number, page in enumerate(json.loads(data)["pages"], 1):
        at = {"page_no": number}
        yield "page", at | {"width": float(page["width"]), "height": float(page["height"])}
        for i, w in enumerate(page.get("words", ())):
            yield "word", at | {"word_seq": i, "text": w[4]} | box(w)
        for i, b in enumerate(page.get("blocks", ())):
            yield "block", at | {"block_seq": i, "text": b[4], "block_type": b[5] if len(b) > 5 else 0} | box(b)
        for i, d in enumerate(page.get("drawings", ())):
            yield "drawing", at | {"drawing_seq": i} | box(d["rect"])
            lines = [x for x in d.get("items", ()) if x[0] == "l"]
            for j, (_, (ax, ay), (zx, zy)) in enumerate(lines):
                yield "segment", at | {"drawing_seq": i, "item_seq": j, "kind": "l", "p1x": float(ax), "p1y": float(ay), "p2x": float(zx), "p2y": float(zy)} | {f"d{k}": v for k, v in box(d["rect"]).items()}


#: What a partition holds of files, as Spark's own file sources pack them; the option maxPartitionBytes changes it.
PACK = 128 << 20


def _fields(relation: str) -> list[str]:
    """Columns of a relation with their types, without those of its page."""
    return [c for c in RELATIONS[relation].split(", ") if c.split()[0] not in ("doc_id", "page_no")]


#: A page with all its relations as lists, and what is wrong with a file that could not be parsed.
NESTED = "doc_id string, page_no long, " + ", ".join(f"{r} array<struct<{', '.join(c.replace(' ', ': ', 1) for c in _fields(r))}>>" for r in RELATIONS) + ", error string"


def packed(files: list[tuple[str, int]], most: int) -> list[list[str]]:
    """Files in groups of at most ``most`` bytes, largest first; a larger file is a group of its own."""
    groups: list[list[str]] = []
    room = 0
    for path, size in sorted(files, key=lambda f: (-f[1], f[0])):
        if not groups or size > room:
            groups.append([])
            room = most
        groups[-1].append(path)
        room -= size
    return groups


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, parser: str, path: str, pattern: str, most: int, keep: bool):
        self.parser, self.path, self.pattern, self.most, self.keep = parser, path, pattern, most, keep

    def partitions(self) -> list[InputPartition]:
        files = [self.path] if os.path.isfile(self.path) else glob.glob(os.path.join(glob.escape(self.path), self.pattern))
        return [_Files(g) for g in packed([(f, os.path.getsize(f)) for f in files], self.most)]

    def pages(self, path: str) -> Iterator[tuple[int | None, dict[str, list[dict]]]]:
        """A file's pages with their rows by relation, in the order in which the parser names the pages first."""
        module, _, name = self.parser.partition(":")
        found: dict[int | None, dict[str, list[dict]]] = {}
        with open(path, "rb") as f:
            for relation, row in getattr(importlib.import_module(module), name)(f.read()):
                found.setdefault(row.get("page_no"), {}).setdefault(relation, []).append(row)
        yield from found.items()

    def told(self, path: str) -> Iterator[tuple]:
        doc = os.path.splitext(os.path.basename(path))[0]
        try:
            listed = list(self.pages(path))
        except Exception as e:
            if not self.keep:
                raise ValueError(f"{path} could not be parsed: {e}") from e
            yield (doc, None, *([] for _ in RELATIONS), f"{type(e).__name__}: {e}")
            return
        for page, rows in listed:
            yield (doc, page, *rows_of(rows), None)

    def read(self, partition: _Files | None) -> Iterator[tuple]:
        for path in partition.paths if partition else ():  # a folder without files
            yield from self.told(path)


def rows_of(rows: dict[str, list[dict]]) -> list[list[tuple]]:
    names = {r: [c.split()[0] for c in _fields(r)] for r in RELATIONS}
    return [[tuple(row.get(n) for n in names[r]) for row in rows.get(r, ())] for r in RELATIONS]


class _Flat(_Reader):
    """One relation in rows of its own."""

    def __init__(self, relation: str, *args):
        super().__init__(*args)
        self.at = 2 + list(RELATIONS).index(relation)

    def read(self, partition: _Files | None) -> Iterator[tuple]:
        for row in super().read(partition):
            for item in row[self.at]:
                yield (*row[:2], *item)


class LayoutSource(DataSource):
    """Options: path, relation (all, nested by page, if not given), parser ("module:function"), pattern (of file names;
    "*.json" if not given), maxPartitionBytes, mode (PERMISSIVE keeps a file that cannot be parsed as a row with its error
    where relations are nested, and passes over it in one relation; otherwise it ends the job by name)."""

    @classmethod
    def name(cls) -> str:
        return "layout"

    def schema(self) -> str:
        relation = self.options.get("relation")
        return RELATIONS[relation] if relation else NESTED

    def reader(self, schema) -> DataSourceReader:
        parts = urlparse(self.options["path"])
        if parts.scheme not in ("", "file"):
            raise ValueError("parsers read files of a mounted folder")
        get = self.options.get
        args = get("parser", f"{__name__}:json_pages"), unquote(parts.path), get("pattern", "*.json"), int(get("maxPartitionBytes", str(PACK))), get("mode", "").upper() == "PERMISSIVE"
        return _Flat(get("relation"), *args) if get("relation") else _Reader(*args)


def relation_of(nested: DataFrame, relation: str) -> DataFrame:
    """Rows of one relation from nested pages: of a stored table only its own columns are read."""
    names = [c.split()[0] for c in RELATIONS[relation].split(", ")]
    return nested.select("doc_id", "page_no", F.inline(relation)).select(*names)


def read_pages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """One row per page of the files in a folder, or of one file, with its relations as lists; written once, so that no file is parsed again."""
    importable(spark)
    spark.dataSource.register(LayoutSource)
    return stored(spark.read.format("layout").options(**options).load(path), "layout")


def read_layout(spark: SparkSession, path: str, *relations: str, **options: str) -> list:
    """Relations of the files in a folder, or of one file: each file is parsed once, whatever is read of them.

    Rows keep no order but their numbers. A folder without files gives empty relations; a file that cannot be parsed
    ends the job and is named, or has no rows with mode="PERMISSIVE" (read_pages tells its error)."""
    nested = read_pages(spark, path, **options)
    return [relation_of(nested, r) for r in relations]
