"""Landed search pages as a data source of Spark's: spark.read and readStream.format("landed_search")."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "page long, pos int, citation string, date date, title string, case_number string, judges array<string>, hit string"
ARROW = pa.schema([("page", pa.int64()), ("pos", pa.int32()), ("citation", pa.string()), ("date", pa.date32()), ("title", pa.string()), ("case_number", pa.string()), ("judges", pa.list_(pa.string())), ("hit", pa.string())])
#: Pages of one task, if each is a file; a file of several pages is read by one task.
PAGES = 64
#: The number of a page in the names of its file and folders: page-12.json, page=12/part-0.txt; or the first and the last that a file may hold: pages=65-128/part-0.txt.
NUMBER = re.compile(r"\bpages?[-=](\d+)(?:-(\d+))?")
#: The beginning of a line of a file of several pages.
LINE = re.compile(r'\s*\{\s*"page"\s*:\s*(\d+)\s*[,}]')


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "file://", 1))


def landed(path: str) -> list[tuple[int, int, str]]:
    """First and last number, and file, of all landed pages, ascending: a file is one page, or has a page on each line, an object with page and data."""
    where, folder = _place(path)
    files = where.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
    found = [(n[-1], f.path) for f in files if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")) and (n := NUMBER.findall(f.path[len(folder) :]))]
    return sorted((int(first), int(last or first), file) for (first, last), file in found)


def _text(value: object) -> str | None:
    return value if isinstance(value, str) else None


def _first(value: object) -> str | None:
    return _text(value[0]) if isinstance(value, list) and value else None


def _day(text: str | None) -> date | None:
    try:
        return date.fromisoformat((text or "")[:10])
    except ValueError:
        return None


def hits(number: int, content: str) -> list[dict]:
    """The hits of one page; items that aren't objects, and blank citations, are dropped, and a page that is no JSON has none."""
    try:
        data = json.loads(content)
    except ValueError:
        return []
    inner = data.get("data") if isinstance(data, dict) else None
    results = inner.get("results") if isinstance(inner, dict) else None
    out = []
    for pos, item in enumerate(results if isinstance(results, list) else ()):
        citation = " ".join((_text(item.get("ncitation")) or "").split()) if isinstance(item, dict) else ""
        if citation:
            corams = item.get("corams")
            judges = [x for x in corams if isinstance(x, str)] if isinstance(corams, list) else None
            hit = json.dumps(item, ensure_ascii=False, separators=(",", ":"))
            out.append({"page": number, "pos": pos, "citation": citation, "date": _day(_first(item.get("dates"))), "title": _first(item.get("titles")), "case_number": _text(item.get("casenumber")), "judges": judges, "hit": hit})
    return out


def _read(where: fs.FileSystem, file: str) -> str:
    with where.open_input_stream(file) as f:
        return f.read().decode()


def _pages(where: fs.FileSystem, first: int, last: int, file: str) -> list[tuple[int, str]]:
    """Number and content of each page of a file, ascending; lines without a number of the file's range are no pages."""
    content = _read(where, file)
    if first == last:
        return [(first, content)]
    found = []
    for line in content.split("\n"):
        if (n := LINE.match(line)) and first <= int(n[1]) <= last:
            found.append((int(n[1]), line))
    return sorted(found)


class Pages(InputPartition):
    """Files, and the pages that are asked for: those behind `after`, up to `end`."""

    def __init__(self, files: list[tuple[int, int, str]], after: int | None = None, end: int | None = None):
        self.files, self.after, self.end = files, after, end


class _Pages:
    def __init__(self, options: dict[str, str]):
        self.path, self.size = options["path"], int(options.get("pagesPerTask", PAGES))

    def split(self, files: list[tuple[int, int, str]], after: int | None = None, end: int | None = None) -> list[Pages]:
        single, several = [f for f in files if f[0] == f[1]], [f for f in files if f[0] != f[1]]
        return [Pages(single[k : k + self.size], after, end) for k in range(0, len(single), self.size)] + [Pages([f], after, end) for f in several]

    def rows(self, part: Pages | None) -> Iterator[pa.RecordBatch]:
        where, _ = _place(self.path)
        for file in part.files if part else ():  # Spark makes one partition of none
            for number, content in _pages(where, *file):
                if (part.after is None or part.after < number) and (part.end is None or number <= part.end):
                    yield pa.RecordBatch.from_pylist(hits(number, content), schema=ARROW)


class LandedReader(_Pages, DataSourceReader):
    def partitions(self) -> list[Pages]:
        return self.split(landed(self.path))

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.rows(partition)


class WalkReader(_Pages, DataSourceStreamReader):
    """Pages in the order of their numbers, newest hits first, up to the page on which a hit older than the mark appears: there the walk stops.

    The offset is the last page taken, and the mark. The driver lists the files, and reads the dates of the pages behind the last offset until it finds the stop, a file at a time.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.mark, self.taken, self.looked, self.stopped = _day(options.get("mark")), 0, 0, False

    def initialOffset(self) -> dict:
        return {"page": 0, "mark": str(self.mark or "")}

    def latestOffset(self) -> dict:
        where, _ = _place(self.path)
        known = max(self.taken, self.looked)
        ahead = [] if self.stopped else [f for f in landed(self.path) if f[1] > known]
        if not self.mark:
            # Nothing stops the walk: of files of several pages only the last ones are opened, to see how far they go.
            for first, last, file in sorted(ahead, key=lambda f: -f[1]):
                if last <= self.looked:
                    break
                self.looked = max([self.looked, *(n for n, _ in _pages(where, first, last, file))] if first != last else [self.looked, last])
            return {"page": max(known, self.looked), "mark": ""}
        for number, content in self._in_order(where, ahead):
            if number <= known:
                continue
            self.looked = number
            if any(h["date"] is not None and h["date"] < self.mark for h in hits(number, content)):
                self.stopped = True
                break
        return {"page": max(self.taken, self.looked), "mark": str(self.mark or "")}

    @staticmethod
    def _in_order(where: fs.FileSystem, files: list[tuple[int, int, str]]) -> Iterator[tuple[int, str]]:
        """The pages of files by their numbers; files whose ranges meet are read together."""
        k = 0
        while k < len(files):
            end, last = k + 1, files[k][1]
            while end < len(files) and files[end][0] <= last:
                last, end = max(last, files[end][1]), end + 1
            yield from sorted(p for f in files[k:end] for p in _pages(where, *f))
            k = end

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.split([f for f in landed(self.path) if start["page"] < f[1] and f[0] <= end["page"]], start["page"], end["page"])

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        self.taken = max(self.taken, end["page"])


class LandedSearch(DataSource):
    """Hits of landed search pages (SCHEMA). path: a folder of one page a file, JSON, numbered by page-12.json or page=12/, or of many
    pages a file, each on a line that begins with its number, {"page": 70, "data": ...}, in files named by the range of their numbers, pages=65-128/. Many pages should land so: a file for each costs more than its rows. Options: mark (a date, for streams), pagesPerTask.

    A walk is one folder: pages that land later have higher numbers. Without a mark the walk goes to the last page there is.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.options)

    def streamReader(self, schema) -> WalkReader:
        return WalkReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedSearch)
