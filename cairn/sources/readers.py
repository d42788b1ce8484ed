"""Readers. Every cell arrives as text; types are cast later, where a bad cast can be seen."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaChanged(ValueError):
    """A file no longer has the columns or the envelope its reader was written for."""


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_staged_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC1, SRC2, SRC18: text columns, quotes doubled, short rows padded with NULL; a missing file with known columns is empty."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("enforceSchema", False)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if columns is not None and not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.createDataFrame([], text_schema(columns))
    df = reader.csv(path)
    return df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))


def from_rows(spark: SparkSession, rows: list[dict], columns: list[str]) -> DataFrame:
    """SRC3: small computed rows as a staging table."""
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], text_schema(columns))


def register_manifest(spark: SparkSession, folder: str) -> list[str]:
    """SRC4: a view for every Parquet entry of the folder's manifest."""
    names = [r["name"] for r in spark.read.json(f"{folder}/manifest.json").where("kind IN ('table', 'view')").select("name").collect()]
    for name in names:
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    return names


def json_list(df: DataFrame, column: str) -> DataFrame:
    """SRC5: a JSON array cell as an array; bad JSON is an empty one."""
    return df.withColumn(column, F.coalesce(F.from_json(column, "array<string>"), F.array().cast("array<string>")))


def read_delimited(spark: SparkSession, path: str, sep: str, keep: Callable | None = None) -> DataFrame:
    """SRC6, SRC7: delimited text with stripped headers; ``keep`` gets the frame and gives a condition."""
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    df = df.toDF(*(c.strip() for c in df.columns))
    return df.where(keep(df)) if keep else df


def read_sniffed(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: tabs or commas, whichever the first line has more of."""
    first = spark.read.text(path).first()
    line = first[0] if first else ""
    return read_delimited(spark, path, "\t" if line.count("\t") > line.count(",") else ",")


def read_tokens(spark: SparkSession, path: str, places: dict[str, int]) -> DataFrame:
    """SRC9: white-space separated text; a column is the token at a place."""
    parts = spark.read.text(path).where("trim(value) <> ''").select(F.split(F.trim("value"), r"\s+").alias("t"))
    return parts.select(*(F.get("t", F.lit(i)).alias(c) for c, i in places.items()))


def read_zipped(spark: SparkSession, path: str, member: str, sep: str, columns: list[str]) -> DataFrame:
    """SRC7, SRC10, SRC14: one delimited member per archive, by a pattern of its name; archives are read in parallel."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, content in zip(frame["path"], frame["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in sorted(n for n in archive.namelist() if re.fullmatch(member, n)):
                        with archive.open(name) as f:
                            for part in pd.read_csv(f, sep=sep, dtype=str, keep_default_na=False, chunksize=20_000):
                                part.columns = [c.strip() for c in part.columns]
                                if missing := [c for c in columns if c not in part.columns]:
                                    raise SchemaChanged(f"{where}!{name}: no column {missing}")
                                yield part[columns]

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, text_schema(columns))


def workbook_rows(content: bytes, sheet: str) -> Iterator[list[str]]:
    """Cells of the first sheet whose name matches, as text, from the workbook's own XML."""
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    rel = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{{{ns['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", ns)]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in ElementTree.fromstring(z.read("xl/workbook.xml")).findall("m:sheets/m:sheet", ns):
            if re.fullmatch(sheet, s.get("name")):
                target = targets[s.get(rel)].lstrip("/")
                root = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
                for row in root.findall("m:sheetData/m:row", ns):
                    cells: dict[int, str] = {}
                    for c in row.findall("m:c", ns):
                        at = 0
                        for ch in re.match("[A-Z]+", c.get("r"))[0]:
                            at = at * 26 + ord(ch) - 64
                        v = c.find("m:v", ns)
                        text = "".join(t.text or "" for t in c.iter(f"{{{ns['m']}}}t")) if c.get("t") == "inlineStr" else v.text if v is not None else ""
                        cells[at - 1] = shared[int(text)] if c.get("t") == "s" else text or ""
                    yield [cells.get(k, "") for k in range(max(cells, default=-1) + 1)]
                return
    raise SchemaChanged(f"no sheet {sheet}")


def read_workbook(spark: SparkSession, path: str, sheet: str, columns: list[str], header_column: str) -> DataFrame:
    """SRC11-SRC13: finds the header row by one of its cells, and refuses a sheet without all the columns."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for where, content in zip(frame["path"], frame["content"], strict=True):
                found = workbook_rows(content, sheet)
                header = next((r for r in found if header_column in [c.strip() for c in r]), None)
                names = [c.strip() for c in header or []]
                if missing := [c for c in columns if c not in names]:
                    raise SchemaChanged(f"{where}: no column {missing}")
                at = [names.index(c) for c in columns]
                yield pd.DataFrame([[r[k] if k < len(r) else "" for k in at] for r in found if any(r)], columns=columns)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(rows, text_schema(columns))


def read_json_pages(spark: SparkSession, path: str, items: str, schema: str) -> DataFrame:
    """SRC15: the items of saved API answers; an answer without the envelope raises."""
    pages = spark.read.text(path, wholetext=True).select(F.from_json("value", f"{items} array<struct<{schema}>>").alias("p"))
    checked = pages.select(F.coalesce(F.col(f"p.{items}"), F.raise_error(F.lit(f"answer has no {items}")).cast(f"array<struct<{schema}>>")).alias("i"))
    return checked.select(F.explode("i").alias("i")).select("i.*")


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.heading, self.rows, self.cell, self.kind = "", [], None, ""

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "h2", "h3", "h4"):
            self.heading, self.kind = "", "h"
        elif tag == "tr":
            self.rows.append((self.heading.strip(), []))
        elif tag in ("td", "th") and self.rows:
            self.rows[-1][1].append("")
            self.kind = "c"

    def handle_endtag(self, tag):
        if tag in ("td", "th", "h1", "h2", "h3", "h4"):
            self.kind = ""

    def handle_data(self, data):
        if self.kind == "h":
            self.heading += data
        elif self.kind == "c":
            self.rows[-1][1][-1] += data


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """SRC16: (key, heading, row, cells) of every table row under the nearest heading."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, page in zip(frame[key], frame[html], strict=True):
                parser = _Tables()
                parser.feed(page or "")
                out += [(k, h, n, [" ".join(c.split()) for c in cells]) for n, (h, cells) in enumerate(parser.rows)]
            yield pd.DataFrame(out, columns=[key, "heading", "row", "cells"])

    return pages.select(key, html).mapInPandas(rows, f"{key} {pages.schema[key].dataType.simpleString()}, heading string, row int, cells array<string>")


def topology_rings(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """SRC17: (id, ring, n, x, y) of a delta-encoded topology, decoded by Spark's own JSON reader and a running sum.

    Arcs are cumulative sums of their deltas; a negative reference ~k walks arc k backwards, and each arc after a
    ring's first leaves out the point it shares with the one before.
    """
    schema = f"transform struct<scale:array<double>,translate:array<double>>, arcs array<array<array<double>>>, objects struct<{layer}:struct<geometries:array<struct<id:string,type:string,arcs:string>>>>"
    doc = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("t")).select("t.*")
    from pyspark.sql import Window as W

    steps = doc.select("transform", F.posexplode("arcs").alias("arc", "a")).select("transform", "arc", F.posexplode("a").alias("n", "d"))
    running = W.partitionBy("arc").orderBy("n")
    place = lambda k: F.sum(F.col("d")[k]).over(running) * F.col("transform.scale")[k] + F.col("transform.translate")[k]
    points = steps.select("arc", "n", place(0).alias("x"), place(1).alias("y"), F.count("*").over(W.partitionBy("arc")).alias("size"))
    shapes = doc.select(F.explode(f"objects.{layer}.geometries").alias("g")).select("g.*")
    polygon = F.transform(F.from_json("arcs", "array<array<int>>"), lambda r: r)
    multi = F.flatten(F.from_json("arcs", "array<array<array<int>>>"))
    rings = shapes.select("id", F.posexplode(F.when(F.col("type") == "Polygon", polygon).otherwise(multi)).alias("ring", "refs")).select("id", "ring", F.posexplode("refs").alias("part", "ref"))
    named = rings.withColumn("arc", F.when(F.col("ref") < 0, -F.col("ref") - 1).otherwise(F.col("ref")))
    walked = named.join(points, "arc").withColumn("step", F.when(F.col("ref") < 0, F.col("size") - 1 - F.col("n")).otherwise(F.col("n"))).where("part = 0 OR step > 0")
    return walked.select("id", "ring", F.row_number().over(W.partitionBy("id", "ring").orderBy("part", "step")).alias("n"), "x", "y")


def expand_requests(registry: DataFrame) -> DataFrame:
    """SRC20: one row per source and parameter set; {name} in the URL template is filled from a map of parameters."""
    one = registry.withColumn("p", F.explode_outer("params"))
    filled = F.aggregate(F.coalesce(F.map_entries("p"), F.array().cast("array<struct<key:string,value:string>>")), F.col("url"), lambda u, e: F.replace(u, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))
    return one.select("source_id", filled.alias("url"))


def unseen(feed: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """SRC22: rows whose change hash isn't known yet."""
    return feed.join(known.select(*keys), keys, "left_anti")
