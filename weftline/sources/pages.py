"""A Spark data source for paged documents: positioned blocks, or the text of pages.

    spark.dataSource.register(PagedDocuments)
    spark.read.format("paged").option("path", ...).option("opener", "package.module:function").load()

The opener is a function of the path that returns an object with n_pages, blocks(page),
which gives (x0, y0, x1, y1, text, number, type) for each block, and, where they are
asked for, text(page) and width(page): a thin wrapper around whatever library reads the
format. `text_file` opens plain text with form feeds between pages. Pages are read in
ranges of pages_per_task, each in a task of its own.

Option content: blocks (the default) or text, for a row for each page. Option volumes,
such as "1:0-40,2:40-90", names ranges of pages (the end is left out); pages outside
all of them are not read; without it the document is volume 1. With option pushdown
(and spark.sql.python.filterPushdown.enabled, without which Spark refuses it) filters on
page and volume are pushed down: only the pages that they allow are put into partitions
and opened.
"""

from __future__ import annotations

import importlib
import math
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

_BLOCKS = "volume int, page int, block_no int, x0 double, y0 double, x1 double, y1 double, text string, type int"
_TEXT = "volume int, page int, width double, text string"


class PageRange(InputPartition):
    def __init__(self, first: int, end: int, volume: int = 1):
        self.first, self.end, self.volume = first, end, volume


def opened(options: dict):
    module, _, name = options["opener"].partition(":")
    return getattr(importlib.import_module(module), name)(options["path"])


class TextFile:
    """Plain text with form feeds between pages; a block is a paragraph, its place the number of its first line."""

    def __init__(self, path: str):
        with open(path.removeprefix("file://"), encoding="utf-8", newline="") as file:
            self.pages = file.read().removesuffix("\f").split("\f")
        self.n_pages = len(self.pages)

    def text(self, page: int) -> str:
        return self.pages[page]

    def width(self, page: int) -> float:
        return float(max(map(len, self.pages[page].split("\n"))))

    def blocks(self, page: int) -> Iterator[tuple]:
        number, start, lines = 0, 0, []
        for y, line in enumerate([*self.pages[page].split("\n"), ""]):
            if line.strip():
                start = start if lines else y
                lines.append(line)
            elif lines:
                x = min(len(x) - len(x.lstrip()) for x in lines)
                yield x, start, max(map(len, lines)), y, "\n".join(lines), number, 0
                number, lines = number + 1, []


def text_file(path: str) -> TextFile:
    return TextFile(path)


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.pages, self.volumes = [0, math.inf], [-math.inf, math.inf]
        self.only: dict[str, set] = {}

    def taken(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes the filters that bound pages and volumes; gives back the others."""
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            bounds = {"page": self.pages, "volume": self.volumes}.get(column)
            if bounds is None or not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            if isinstance(f, (EqualTo, In)):
                values = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.only[column] = self.only.get(column, values) & values
                values = {v for v in self.only[column] if v is not None} or {-1}
                low, end = min(values), max(values) + 1
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                low, end = f.value + isinstance(f, GreaterThan), math.inf
            else:
                low, end = -math.inf, f.value + isinstance(f, LessThanOrEqual)
            bounds[:] = [max(bounds[0], low), min(bounds[1], end)]

    def partitions(self) -> list[PageRange]:
        n = opened(self.options).n_pages
        step = int(self.options.get("pages_per_task", 200))
        first, end = int(self.options.get("first_page", 0)), min(n, int(self.options.get("end_page", n)))
        ranges = [(1, 0, n)]
        if listed := self.options.get("volumes"):
            ranges = [(int(v), *map(int, span.split("-"))) for v, _, span in (x.partition(":") for x in listed.split(","))]
        found = []
        for volume, a, b in ranges:
            if not self.volumes[0] <= volume < self.volumes[1] or volume not in self.only.get("volume", {volume}):
                continue
            a, b = int(max(a, first, self.pages[0])), int(min(b, end, self.pages[1]))
            found += [PageRange(i, min(i + step, b), volume) for i in range(a, b, step)]
        return found or [PageRange(0, 0)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        if partition.first >= partition.end:
            return
        document, whole = opened(self.options), self.options.get("content", "blocks") == "text"
        for page in range(partition.first, partition.end):
            if page not in self.only.get("page", {page}):
                continue
            if whole:
                yield partition.volume, page, float(document.width(page)), document.text(page)
                continue
            for x0, y0, x1, y1, text, number, kind in document.blocks(page):
                yield partition.volume, page, int(number), float(x0), float(y0), float(x1), float(y1), text, int(kind)


class PushingReader(PagedReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        return self.taken(filters)


class PagedDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return _TEXT if self.options.get("content", "blocks") == "text" else _BLOCKS

    def reader(self, schema) -> PagedReader:
        pushes = str(self.options.get("pushdown", "false")).lower() == "true"
        return PushingReader(self.options) if pushes else PagedReader(self.options)
