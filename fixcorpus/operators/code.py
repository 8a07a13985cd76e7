"""Diffs and code hunks: parsing, grouping, caps, sizes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HUNKS = "array<struct<file:string,hunks:array<struct<start_line:int,code:string>>>>"
#: Lines per file, characters per hunk, characters and files per row that are kept (fixed values).
FILE_LINES, HUNK_CHARS, ROW_CHARS, ROW_FILES = 400, 16_000, 8_000, 12
CUT = "… [truncated]"
_HEADER = re.compile(r"@@ -(\d+)(?:,\d+)? \+(\d+)(?:,\d+)? @@")
_TARGET = re.compile(r" b/(\S+)$")


class _Side:
    """The hunks of one side of a diff, grouped by file in order of appearance."""

    def __init__(self) -> None:
        self.files: dict[str, list[dict]] = {}
        self.hunk: dict | None = None

    def open(self, file: str, line: int) -> None:
        self.hunk = {"file": file, "start_line": line, "lines": []}

    def line(self, text: str) -> None:
        if self.hunk is None:
            return
        if not self.hunk["lines"]:
            self.files.setdefault(self.hunk["file"], []).append(self.hunk)
        self.hunk["lines"].append(text)

    def capped(self) -> list[dict]:
        out = []
        for file, hunks in self.files.items():
            kept, lines = [], 0
            for h in hunks:
                if lines >= FILE_LINES:
                    kept.append({"start_line": h["start_line"], "code": CUT})
                    break
                code = "\n".join(h["lines"])
                lines_here = len(h["lines"])
                if len(code) > HUNK_CHARS:
                    code = f"{code[:HUNK_CHARS]}\n{CUT}"
                    lines_here = code.count("\n") + 1
                kept.append({"start_line": h["start_line"], "code": code})
                lines += lines_here
            out.append({"file": file, "hunks": kept})
        return out


def parse(diff: str) -> tuple[list[str], list[dict], list[dict]]:
    """(files, hunks before, hunks after) of a unified diff; context lines belong to both sides."""
    files: list[str] = []
    before, after = _Side(), _Side()
    current: str | None = None
    inside = False
    for raw in re.split(r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]", diff):
        if raw.startswith("diff --git"):
            target = _TARGET.search(raw)
            current = target.group(1) if target else None
            if current:
                files.append(current)
        elif current and (head := _HEADER.match(raw)):
            before.open(current, int(head.group(1)))
            after.open(current, int(head.group(2)))
            inside = True
        elif current and inside and raw[:1] in ("+", "-", " ") and raw[:3] not in ("+++", "---"):
            if raw[0] != "+":
                before.line(raw[1:])
            if raw[0] != "-":
                after.line(raw[1:])
    return files, before.capped(), after.capped()


#: Diffs longer than this are used but not kept for later runs (fixed value).
KEPT_CHARS = 200_000


def with_diffs(findings: DataFrame, diffs: DataFrame) -> DataFrame:
    """Findings with the diff of their address from a table (source_url, diff): null not looked for, empty known to be missing; and whether it may be kept."""
    one = diffs.filter("source_url is not null").groupBy("source_url").agg(F.max("diff").alias("diff"))
    x = findings.join(one, "source_url", "left")
    return x.withColumn("keep", F.coalesce(F.length("diff") <= KEPT_CHARS, F.lit(False)))


def parse_diffs(diffs: DataFrame, text_col: str = "diff") -> DataFrame:
    """Adds files, pre and post to a table of diffs (Arrow batches); a null diff has none of them."""
    fields = [f for f in diffs.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", files array<string>, pre {HUNKS}, post {HUNKS}"
    side = pa.list_(pa.struct([("file", pa.string()), ("hunks", pa.list_(pa.struct([("start_line", pa.int32()), ("code", pa.string())])))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parsed = [parse(x or "") for x in b.column(text_col).to_pylist()]
            files, pre, post = ([p[i] for p in parsed] for i in range(3))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(files, pa.list_(pa.string())), pa.array(pre, side), pa.array(post, side)], names=[*b.schema.names, "files", "pre", "post"])

    return diffs.mapInArrow(run, schema)


def hunks_of(c: Column) -> Column:
    """A code column as structs; plain text and broken documents are null."""
    return F.from_json(F.when(F.trim(c).startswith("["), c), HUNKS)


def row_cap(side: Column) -> Column:
    """The first files while their JSON stays under the row's limit, at most ROW_FILES."""
    start = F.struct(F.lit(0).alias("used"), F.lit(False).alias("full"), F.array().cast(HUNKS).alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        used = acc["used"] + F.length(F.to_json(x))
        full = acc["full"] | (used > ROW_CHARS)
        return F.struct(used.alias("used"), full.alias("full"), F.when(full, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(x))).alias("kept"))

    return F.aggregate(F.slice(side, 1, ROW_FILES), start, step, lambda acc: acc["kept"])


def line_count(side: Column) -> Column:
    """Lines over all hunks of a side."""
    codes = F.flatten(F.transform(side, lambda x: F.transform(x["hunks"], lambda h: h["code"])))
    return F.aggregate(codes, F.lit(0), lambda acc, c: acc + F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1)


def condensed(diff: Column, cap: int = 6000) -> Column:
    """Only headers and changed lines of a diff, cut to ``cap`` characters."""
    keep = F.filter(F.split(diff, "\n"), lambda x: x.startswith("diff --git") | x.startswith("@@") | (x.rlike("^[+-]") & ~x.startswith("+++") & ~x.startswith("---")))
    return F.substring(F.array_join(keep, "\n"), 1, cap)
