"""Source trees as a Python DataSource: Spark's own file readers leave out names that begin with _ or ., and empty files."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.schema import FILE

# Folders that no walk enters, and what counts as a document.
SKIPPED = (".git", ".venv", "venv", "__pycache__", ".mypy_cache", ".pytest_cache", "dist", "build")
DOCUMENTS = (".py", ".md", ".txt", ".rst")
MOST_BYTES = 2_000_000


def walk(root: str, suffixes: tuple[str, ...], dot_folders: bool, readme: bool, most: int) -> Iterator[tuple[str, str, int]]:
    """(path, relative path, size) in path order."""
    for folder, names, files in os.walk(root):
        names[:] = sorted(d for d in names if d not in SKIPPED and (dot_folders or not d.startswith(".")))
        for f in sorted(files):
            if os.path.splitext(f)[1].lower() not in suffixes and not (readme and f.lower() == "readme"):
                continue
            full = os.path.join(folder, f)
            try:
                size = os.path.getsize(full)
            except OSError:
                continue
            if not most or size <= most:
                yield full, os.path.relpath(full, root).replace("\\", "/"), size


class Chunk(InputPartition):
    def __init__(self, files):
        self.files = files


class TreeReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.errors = options.get("errors", "ignore")
        self.suffixes = tuple(options.get("suffixes", ".py").split(","))
        self.dot, self.readme = options.get("dotfolders", "false") == "true", options.get("readme", "false") == "true"
        self.most, self.bytes = int(options.get("mostbytes", "0")), int(options.get("chunkbytes", str(16 << 20)))

    def partitions(self):
        """Files in runs of about chunkbytes."""
        out, held = [[]], 0
        for item in walk(self.root, self.suffixes, self.dot, self.readme, self.most):
            if held > self.bytes:
                out.append([])
                held = 0
            out[-1].append(item)
            held += item[2]
        return [Chunk(x) for x in out]

    def read(self, partition):
        for full, rel, size in partition.files:
            try:
                with open(full, "rb") as f:
                    yield rel, f.read().decode("utf-8", self.errors), size
            except OSError:
                continue


class SourceTree(DataSource):
    @classmethod
    def name(cls):
        return "source_tree"

    def schema(self):
        return FILE

    def reader(self, schema):
        return TreeReader(self.options)


def source_tree(spark: SparkSession, root: str, kind: str = "python") -> DataFrame:
    """(path, text, size) of a folder that all executors see: kind `python` (.py, no dot folders) or
    `documents` (.py .md .txt .rst and README, up to 2,000,000 bytes, bad bytes replaced)."""
    spark.dataSource.register(SourceTree)
    reader = spark.read.format("source_tree")
    if kind == "documents":
        reader = reader.option("suffixes", ",".join(DOCUMENTS)).option("errors", "replace").option("dotfolders", "true").option("readme", "true").option("mostbytes", str(MOST_BYTES))
    return reader.load(root)
