"""A Spark data source for archives, workbooks and compressed text: each member or sheet is a partition of its own.

    spark.dataSource.register(ArchiveSource)
    spark.read.format("archive").option("path", folder).option("member", r"cbp.*\\.csv").option("columns", "fips,est").load()

The headers of all members are read and checked while the schema is asked for, before any row is. Files are opened
through Arrow's file systems, so a path may lie in any store that these reach (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import csv
import gzip
import io
import json
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cairn.sources.readers import SchemaChanged

#: Rows of an Arrow batch.
BATCH = 8192
#: Rows looked through for a header.
HEADER_ROWS = 200
#: The columns that say where a row comes from.
PLACE = ("source_file", "source_member")
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REFERENCE = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if re.match(r"[a-z][a-z0-9+.-]+:/", path) and not path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)


def files_of(path: str) -> list[str]:
    """The files of a folder (not of folders in it), those a pattern in the last part of the path matches, or the file itself."""
    fs, inner = file_system(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    folder, name = posixpath.split(inner)
    if any(c in name for c in "*?["):
        chosen = lambda p: fnmatchcase(posixpath.basename(p), name)
    elif fs.get_file_info(inner).type == pafs.FileType.Directory:
        folder, chosen = inner, lambda p: not posixpath.basename(p).startswith(("_", "."))
    else:
        return [path]
    return sorted(prefix + f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.type == pafs.FileType.File and chosen(f.path))


def _cells(row: ElementTree.Element, shared: list[str]) -> list[str]:
    cells: dict[int, str] = {}
    for c in row.iter(f"{_MAIN}c"):
        at = 0
        for letter in re.match("[A-Z]*", c.get("r", ""))[0]:
            at = at * 26 + ord(letter) - 64
        at = at or max(cells, default=-1) + 2  # a cell without a reference follows the one before
        value = c.find(f"{_MAIN}v")
        if c.get("t") == "inlineStr":
            text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
        else:
            text = (value.text or "") if value is not None else ""
        cells[at - 1] = shared[int(text)] if c.get("t") == "s" and text else text
    return [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]


def sheet_files(archive: zipfile.ZipFile) -> dict[str, str]:
    """The member of every sheet by the sheet's name, in the workbook's order."""
    targets = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
    sheets = ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
    return {s.get("name"): (t if (t := targets[s.get(_REFERENCE)]).startswith("xl/") else f"xl/{t}") for s in sheets}


def sheet_rows(archive: zipfile.ZipFile, member: str) -> Iterator[list[str]]:
    """The rows of a sheet as text, read as a stream; a row that is left out in the file is left out here."""
    shared = []
    if "xl/sharedStrings.xml" in archive.namelist():
        with archive.open("xl/sharedStrings.xml") as f:
            for _, item in ElementTree.iterparse(f):
                if item.tag == f"{_MAIN}si":
                    shared.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
                    item.clear()
    with archive.open(member) as f:
        data = None
        for event, element in ElementTree.iterparse(f, ("start", "end")):
            if event == "start" and element.tag == f"{_MAIN}sheetData":
                data = element
            elif event == "end" and element.tag == f"{_MAIN}row":
                yield _cells(element, shared)
                data.clear()


@dataclass
class Options:
    """How members are chosen and read.

    member: a pattern of the whole name of an archive's members; sheet: one of the names of a workbook's sheets; without
    either, files are delimited text, plain or in gzip. one: each archive must have exactly one such member.
    columns: the columns wanted, separated by commas, case and order as in the file; none: those of the first header.
    exact: a header must be the columns and nothing else. header: the header is the first row with this cell; else the
    first row, or the second if the first begins with ``disclaimer``. sep: the delimiter. vocabulary: JSON of the values
    allowed in a column; blank is always allowed.
    """

    path: str
    member: str | None
    sheet: str | None
    one: bool
    columns: list[str]
    exact: bool
    header: str | None
    disclaimer: str | None
    sep: str
    vocabulary: dict[str, list[str]]

    @classmethod
    def of(cls, given: dict[str, str]) -> Options:
        g = {k.lower(): v for k, v in given.items()}
        yes = lambda k: g.get(k, "false").lower() == "true"
        columns = [c.strip() for c in g.get("columns", "").split(",") if c.strip()]
        if "path" not in g:
            raise ValueError("the option path is needed")
        return cls(g["path"], g.get("member"), g.get("sheet"), yes("one"), columns, yes("exact"), g.get("header"), g.get("disclaimer"), g.get("sep", ","), json.loads(g.get("vocabulary", "{}")))


@dataclass
class Part(InputPartition):
    """A member of an archive, a sheet of a workbook, or a whole file."""

    path: str
    member: str = ""
    inner: str = ""

    def __str__(self) -> str:
        return f"{self.path}!{self.member}" if self.member else self.path


def parts_of(options: Options) -> list[Part]:
    found = []
    for path in files_of(options.path):
        if not (options.member or options.sheet):
            found.append(Part(path))
            continue
        fs, inner = file_system(path)
        with fs.open_input_file(inner) as f:
            try:
                archive = zipfile.ZipFile(f)
            except zipfile.BadZipFile as e:
                raise SchemaChanged(f"{path}: not an archive") from e
            if options.sheet:
                mine = [Part(path, name, member) for name, member in sheet_files(archive).items() if re.fullmatch(options.sheet, name)]
            else:
                mine = [Part(path, name, name) for name in sorted(archive.namelist()) if re.fullmatch(options.member, name)]
        if not mine or options.one and len(mine) != 1:
            raise SchemaChanged(f"{path}: {len(mine)} members match {options.sheet or options.member}: {[p.member for p in mine]}")
        found += mine
    return found


def rows_of(part: Part, options: Options) -> Iterator[list[str]]:
    """All rows of a part as lists of text, the header's first."""
    fs, inner = file_system(part.path)
    with fs.open_input_file(inner) as f:
        if part.member and options.sheet:
            rows = sheet_rows(zipfile.ZipFile(f), part.inner)
        else:
            if part.member:
                raw = zipfile.ZipFile(f).open(part.inner)
            else:
                raw = gzip.GzipFile(fileobj=f) if f.read(2) == b"\x1f\x8b" else f
                f.seek(0)
            rows = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", errors="replace", newline=""), delimiter=options.sep)
        rows = ([c.strip() for c in r] if k < HEADER_ROWS else r for k, r in enumerate(rows))
        if options.header:
            for k, row in enumerate(rows):
                if options.header in row:
                    yield row
                    break
                if k >= HEADER_ROWS:
                    break
            else:
                k = HEADER_ROWS
            if k >= HEADER_ROWS:
                raise SchemaChanged(f"{part}: no header row with {options.header}")
        elif options.disclaimer:
            first = next(rows, [])
            if not (first and first[0].startswith(options.disclaimer)):
                yield first
        yield from rows


def header_of(part: Part, options: Options) -> list[str]:
    return next(rows_of(part, options), [])


def checked(parts: list[Part], options: Options) -> list[str]:
    """The columns, after every part's header was looked at."""
    columns = options.columns
    for part in parts:
        header = header_of(part, options)
        columns = columns or [c for c in header if c]
        if missing := [c for c in columns if c not in header]:
            raise SchemaChanged(f"{part}: no column {missing}")
        if options.exact and header != columns:
            raise SchemaChanged(f"{part}: header is {header}, not {columns}")
    if not columns:
        raise SchemaChanged(f"{options.path}: no columns known and no file to read them from")
    return columns


class ArchiveReader(DataSourceReader):
    def __init__(self, options: Options, columns: list[str]):
        self.options, self.columns = options, columns

    def partitions(self) -> list[Part]:
        return parts_of(self.options) or [Part("")]

    def read(self, part: Part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        rows = rows_of(part, self.options)
        header = next(rows, [])
        if missing := [c for c in self.columns if c not in header]:
            raise SchemaChanged(f"{part}: no column {missing}")
        at = [header.index(c) for c in self.columns]
        allowed = [(k, frozenset(self.options.vocabulary[c])) for k, c in enumerate(self.columns) if c in self.options.vocabulary]
        names, held = [*self.columns, *PLACE], []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) if held else [()] * len(at)
            for k, known in allowed:
                if unknown := sorted({v for v in columns[k] if v} - known):
                    raise SchemaChanged(f"{part}: unknown {self.columns[k]} {unknown}")
            place = [[part.path] * len(held), [part.member] * len(held)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (*columns, *place)], names=names)

        for row in rows:
            if any(row):
                held.append([row[k] if k < len(row) else None for k in at])
                if len(held) == BATCH:
                    yield batch()
                    held = []
        if held:
            yield batch()


class ArchiveSource(DataSource):
    """SRC7, SRC10-SRC14, SRC18: the rows of all members as text columns, with source_file and source_member.

    Cells beyond a short row are null, empty rows are left out, white space around names is stripped. A file that isn't an
    archive, a missing or doubled member, a changed header or an unknown value raises SchemaChanged; all but the last
    before any row is read.
    """

    @classmethod
    def name(cls) -> str:
        return "archive"

    def schema(self) -> T.StructType:
        options = Options.of(self.options)
        columns = checked(parts_of(options), options)
        return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, *PLACE)])

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return ArchiveReader(Options.of(self.options), [c for c in schema.names if c not in PLACE])


def read_archives(spark, path: str, **options):
    """A frame over the archive source; True and False, lists of columns and dicts of allowed values are written out."""
    spark.dataSource.register(ArchiveSource)
    reader = spark.read.format("archive").option("path", path)
    for k, v in options.items():
        text = str(v).lower() if isinstance(v, bool) else ",".join(v) if isinstance(v, (list, tuple)) else json.dumps(v) if isinstance(v, dict) else v
        reader = reader.option(k, text)
    return reader.load()


def _put(path: str, fill) -> None:
    """Write a file beside its place and move it there, so that a task that runs again replaces it whole."""
    fs, inner = file_system(path)
    temporary = f"{inner}.{uuid.uuid4().hex}"
    fs.create_dir(posixpath.dirname(inner))
    with fs.open_output_stream(temporary) as f:
        fill(f)
    fs.move(temporary, inner)


def _text(rows: list[list], sep: str) -> bytes:
    out = io.StringIO()
    csv.writer(out, delimiter=sep, lineterminator="\n").writerows([["" if v is None else v for v in r] for r in rows])
    return out.getvalue().encode()


def write_archives(df, folder: str, file: str, member: str, columns: list[str], sep: str = ",") -> None:
    """An archive for each value of ``file`` (the name of it), with a delimited member for each value of ``member``.

    Each archive is made by one task, from rows that one file can hold.
    """

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        def fill(f):
            with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "made from the given tables\n")
                for name, part in rows.sort_values(columns).groupby(member):
                    archive.writestr(name, _text([columns, *part[columns].values.tolist()], sep))

        _put(f"{folder}/{key[0]}", fill)
        return rows[[file]][:1]

    df.groupBy(file).applyInPandas(write, f"{file} string").write.format("noop").mode("overwrite").save()


def write_workbooks(df, folder: str, file: str, sheet: str, columns: list[str], title: str = "") -> None:
    """A workbook for each value of ``file`` with a sheet for each value of ``sheet``, under a row with a title if there is one. Cells are text."""

    def cells(k: int, row: list) -> str:
        return f'<row r="{k}">' + "".join(f'<c t="inlineStr"><is><t>{escape(str(v))}</t></is></c>' if v is not None else "<c/>" for v in row) + "</row>"

    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        main, office = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        parts = list(rows.sort_values(columns).groupby(sheet))

        def fill(f):
            with zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as book:
                listed = "".join(f'<sheet name="{escape(name)}" sheetId="{k}" r:id="r{k}"/>' for k, (name, _) in enumerate(parts, 1))
                book.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
                related = "".join(f'<Relationship Id="r{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(parts) + 1))
                book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{related}</Relationships>')
                for k, (_, part) in enumerate(parts, 1):
                    lines = [*([[title]] if title else []), columns, *part[columns].values.tolist()]
                    book.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {main}><sheetData>{''.join(cells(n, r) for n, r in enumerate(lines, 1))}</sheetData></worksheet>")

        _put(f"{folder}/{key[0]}", fill)
        return rows[[file]][:1]

    df.groupBy(file).applyInPandas(write, f"{file} string").write.format("noop").mode("overwrite").save()
