"""Workbook ingest: one row per sheet of every workbook in a folder."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.text import nonblank_line_count

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column_index(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{NS}numFmt")}
    out = set()
    xfs = root.find(f"{NS}cellXfs")
    for i, xf in enumerate(xfs if xfs is not None else []):
        fmt = int(xf.get("numFmtId", 0))
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", custom.get(fmt, ""))
        if 14 <= fmt <= 22 or re.search(r"[ymdhs]", code):
            out.add(i)
    return out


def _cell_text(c: ET.Element, shared: list[str], dates: set[int]) -> str:
    kind = c.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(f"{NS}t"))
    v = c.find(f"{NS}v")
    if v is None or v.text is None:
        return ""
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "True" if v.text == "1" else "False"
    if kind != "n":
        return v.text
    if int(c.get("s", 0)) in dates:
        return str(dt.datetime(1899, 12, 30) + dt.timedelta(days=float(v.text)))
    return str(float(v.text)) if re.search("[.eE]", v.text) else str(int(v.text))


def workbook_sheets(content: bytes) -> list[tuple[int, str, str]]:
    """(position, sheet name, rows as tab-joined lines) of one workbook; empty cells are ''."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ET.fromstring(z.read("xl/sharedStrings.xml")):
                shared.append("".join(t.text or "" for t in si.iter(f"{NS}t")))
        dates = _date_styles(z)
        rels = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/")
                for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for pos, s in enumerate(ET.fromstring(z.read("xl/workbook.xml")).iter(f"{NS}sheet")):
            rows: dict[int, dict[int, str]] = {}
            next_row = 0
            for row in ET.fromstring(z.read("xl/" + rels[s.get(f"{REL}id")])).iter(f"{NS}row"):
                next_row = int(row.get("r", next_row + 1))
                cells = rows.setdefault(next_row, {})
                col = -1
                for c in row.iter(f"{NS}c"):
                    col = _column_index(c.get("r")) if c.get("r") else col + 1
                    cells[col] = _cell_text(c, shared, dates)
            width = max((max(r, default=-1) for r in rows.values()), default=-1) + 1
            lines = ["\t".join(rows.get(i, {}).get(j, "") for j in range(width))
                     for i in range(1, max(rows, default=0) + 1)]
            out.append((pos, s.get("name"), "\n".join(lines)))
        return out


def parse_workbooks(files: DataFrame) -> DataFrame:
    """Rows (path, content) to rows (file_name, pos, sheet_name, content, row_count)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p.rsplit("/", 1)[-1], pos, name, text)
                    for p, c in zip(b["path"], b["content"]) for pos, name, text in workbook_sheets(c)]
            yield pd.DataFrame(rows, columns=["file_name", "pos", "sheet_name", "content"])

    out = files.select("path", "content").mapInPandas(
        run, "file_name string, pos int, sheet_name string, content string")
    return out.withColumn("row_count", nonblank_line_count("content"))


def ingest_sheets(spark: SparkSession, path: str, uploaded_at: Column | None = None) -> DataFrame:
    """All workbooks of a folder; files are spread over the tasks by size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    at = F.current_timestamp().cast("timestamp_ntz") if uploaded_at is None else uploaded_at
    return parse_workbooks(files).drop("pos").withColumn("uploaded_at", at)


def sheet_concat(sheets: DataFrame, file: str, pos: str, name: str, content: str,
                 include_names: bool = True) -> DataFrame:
    """One text per file; every sheet is preceded by a ``[Sheet: name]`` line."""
    body = F.col(content)
    if include_names:
        body = F.concat(F.lit("[Sheet: "), F.col(name), F.lit("]\n"), body)
    item = F.struct(F.col(pos).alias("pos"), body.alias("body"))
    parts = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["body"])
    return sheets.groupBy(file).agg(F.array_join(parts, "\n").alias("text"))
