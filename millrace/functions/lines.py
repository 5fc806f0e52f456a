"""Lines, snippets, ids: column expressions over a file's text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What ends a line: CR LF, or one of the single characters that Python's splitlines takes.
LINE_END = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"


def split_lines(text: Column) -> Column:
    """Lines of a text without their ends; a final line end adds no empty line, null and empty texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def with_lines(files: DataFrame, text: str = "text") -> DataFrame:
    """files plus `lines` (array) and `n_lines`."""
    return files.withColumn("lines", split_lines(F.col(text))).withColumn("n_lines", F.size("lines"))


def explode_lines(files: DataFrame, text: str = "text") -> DataFrame:
    """(path, line, text): one row per line, numbered from 1."""
    return with_lines(files, text).select("path", F.posexplode("lines").alias("line", "text")).withColumn("line", F.col("line") + 1)


def snippet(lines: Column, start: Column, end: Column, rstrip: bool = False, numbered: bool = True) -> Column:
    """Lines start..end (clamped to the file), each after its number in four places."""
    lo = F.greatest(start, F.lit(1))
    hi = F.least(F.greatest(end, lo), F.size(lines))
    part = F.slice(lines, lo, F.greatest(hi - lo + 1, F.lit(0)))

    def one(x, i):
        x = F.regexp_replace(x, r"(?U)\s+$", "") if rstrip else x
        return F.format_string("%4d: %s", lo + i, x) if numbered else x

    return F.array_join(F.transform(part, one), "\n")


def stable_id(*parts: Column) -> Column:
    """16 hex digits of SHA-1 over the parts, joined by ||."""
    return F.substring(F.sha1(F.concat_ws("||", *parts)), 1, 16)


def content_hash(text: Column) -> Column:
    """16 hex digits of SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 16)


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), "^ | $", "")


def head_tail(text: Column, limit: int, marker: str = "\n...(truncated)...\n") -> Column:
    """Texts over the limit keep three quarters of it from the head and the rest from the tail."""
    head = int(limit * 0.75)
    tail = limit - head
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, head), F.lit(marker), F.right(text, F.lit(tail))))


def module_name(path: Column) -> Column:
    """Dotted module of a .py path; a package's __init__ is the package."""
    name = F.regexp_replace(F.regexp_replace(F.replace(path, F.lit("\\"), F.lit("/")), r"\.py$", ""), r"(^|/)__init__$", "")
    return F.replace(name, F.lit("/"), F.lit("."))


def matching_lines(files: DataFrame, pattern: str, text: str = "text") -> DataFrame:
    """(path, line_numbers) of the lines in which the pattern is found."""
    hits = F.filter(F.transform("lines", lambda x, i: F.when(x.rlike(pattern), i + 1)), lambda i: i.isNotNull())
    return with_lines(files, text).select("path", hits.alias("line_numbers"))
