"""Imports and symbols of source files: by line patterns, or by the parser in an Arrow batch."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.lines import explode_lines, module_name

# Fixed value.
IMPORT = r"^\s*(?:from\s+([A-Za-z0-9_\.]+)\s+import|import\s+([A-Za-z0-9_\.]+))"


def line_imports(files: DataFrame) -> DataFrame:
    """(path, module, n): import lines per file and first module named."""
    rows = explode_lines(files).where(F.col("text").rlike(IMPORT))
    module = F.coalesce(F.nullif(F.regexp_extract("text", IMPORT, 1), F.lit("")), F.regexp_extract("text", IMPORT, 2))
    return rows.select("path", module.alias("module")).groupBy("path", "module").agg(F.count("*").alias("n"))


def hubs(imports: DataFrame, k: int = 10) -> DataFrame:
    """(path, n): the files with the most imports, ties by path."""
    return imports.groupBy("path").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "path").limit(k)


def internal_edges(files: DataFrame, imports: DataFrame) -> DataFrame:
    """(src, dst): distinct imports of modules whose name, or top package, is among the files'."""
    known = files.select(module_name(F.col("path")).alias("m")).distinct()
    tops = known.select(F.split("m", r"\.")[0].alias("top")).distinct()
    rows = imports.where("module <> ''").withColumn("top", F.split("module", r"\.")[0])
    exact = rows.join(known, F.col("module") == F.col("m"), "left_semi")
    package = rows.join(tops, "top", "left_semi").select(*rows.columns)
    return exact.unionByName(package).select(F.col("path").alias("src"), F.col("module").alias("dst")).distinct()


def degrees(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Out-degree by src and in-degree by dst, over distinct neighbours."""
    return edges.groupBy("src").agg(F.countDistinct("dst").alias("out_degree")), edges.groupBy("dst").agg(F.countDistinct("src").alias("in_degree"))


PARSED = "path string, kind string, name string, start_line int, end_line int"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for path, text in zip(batch["path"], batch["text"]):
            try:
                tree = ast.parse(text or "")
            except (SyntaxError, ValueError):
                rows.append((path, "unparsed", None, 0, 0))
                continue
            for node in ast.walk(tree):
                if isinstance(node, ast.Import):
                    rows += [(path, "import", a.name, node.lineno, node.end_lineno) for a in node.names]
                elif isinstance(node, ast.ImportFrom):
                    rows.append((path, "from", "" if node.level else node.module or "", node.lineno, node.end_lineno))
            for node in tree.body:
                if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                    rows.append((path, "function", node.name, node.lineno, node.end_lineno))
                elif isinstance(node, ast.ClassDef):
                    rows.append((path, "class", node.name, node.lineno, node.end_lineno))
                elif isinstance(node, ast.Assign):
                    rows += [(path, "assign", t.id, node.lineno, node.end_lineno) for t in node.targets if isinstance(t, ast.Name)]
        yield pd.DataFrame(rows, columns=["path", "kind", "name", "start_line", "end_line"])


def parse_files(files: DataFrame) -> DataFrame:
    """(path, kind, name, start_line, end_line): imports anywhere, top-level functions, classes and names; one `unparsed` row for files that do not parse."""
    return files.select("path", "text").mapInPandas(_parse, PARSED)


def module_files(files: DataFrame, module: str) -> DataFrame:
    """Files (path, ...) that make up a module by its dotted name."""
    from millrace.functions.lines import module_name

    return files.where(module_name(F.col("path")) == module)
