"""JSONL items, lists, pairs and clusters, each with its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schema import ITEM


def read_items(spark: SparkSession, *paths: str) -> DataFrame:
    """Items of JSONL files; blank lines do not count, a malformed line raises."""
    return spark.read.schema(ITEM).option("mode", "FAILFAST").json(list(paths))


def done_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) of items that were written before; malformed lines do not count, a missing file has none."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.schema("id string, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    except AnalysisException:
        return spark.createDataFrame([], "id string")
    return rows.where("id is not null").select("id").distinct()


def write_items(items: DataFrame, path: str, append: bool = False) -> None:
    items.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(unit): one per line that is not blank."""
    return spark.read.text(path).select(F.trim("value").alias("unit")).where("unit <> ''")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(a, b, label) of a CSV with a header."""
    rows = spark.read.option("header", True).csv(path)
    a, b, label = rows.columns[:3]
    return rows.select(F.col(a).alias("a"), F.col(b).alias("b"), F.col(label).alias("label"))


def read_keyed(spark: SparkSession, path: str, value_schema: str, key: str) -> DataFrame:
    """Rows of one JSON object {key: record, ...}."""
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.explode(F.from_json("value", f"map<string, {value_schema}>")).alias(key, "_v")).select(key, "_v.*")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(cluster_id, signature_id)."""
    rows = read_keyed(spark, path, "struct<cluster_id: string, signature_ids: array<string>>", "k")
    return rows.select("cluster_id", F.explode("signature_ids").alias("signature_id"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """(a, b, kind), kind in require and disallow."""
    text = spark.read.option("wholetext", True).text(path)
    outer = text.select(F.explode(F.from_json("value", "map<string, map<string, string>>")).alias("a", "m"))
    return outer.select("a", F.explode("m").alias("b", "kind"))


#: Keys of the four tables of name counts, as stored and as used.
NAME_COUNTS = {"first_dict": "first", "last_dict": "last", "first_last_dict": "first_last", "last_first_initial_dict": "last_first_initial"}


def read_name_counts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """(name, n) for each of the four tables of a JSON object of objects."""
    text = spark.read.option("wholetext", True).text(path)
    tables = text.select(F.explode(F.from_json("value", "map<string, map<string, bigint>>")).alias("kind", "m"))
    return {name: tables.where(F.col("kind") == key).select(F.explode("m").alias("name", "n")) for key, name in NAME_COUNTS.items()}


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(name_a, name_b): one pair of names per line, without a header; lines without a pair do not count."""
    rows = spark.read.text(path).select(F.split(F.trim("value"), ",").alias("x")).where(F.size("x") >= 2)
    return rows.select(F.col("x")[0].alias("name_a"), F.col("x")[1].alias("name_b")).distinct()


def read_vectors(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """(key, vector) of .npz files with a matrix `vectors` and as many `keys`, or of Parquet with these columns; keys: (key), only these.

    Files are read by the tasks, one at a time, and their rows are sent in parts."""
    if not path.rstrip("/").endswith(".npz"):
        rows = spark.read.parquet(path).select(F.col("key").cast("string").alias("key"), F.col("vector").cast("array<double>").alias("vector"))
    else:

        def load(batches):
            import io

            import numpy as np
            import pandas as pd

            for batch in batches:
                for content in batch["content"]:
                    with np.load(io.BytesIO(content)) as f:  # arrays only: no pickled objects
                        x, names = f["vectors"], f["keys"].astype(str)
                    for i in range(0, len(names), 10_000):
                        yield pd.DataFrame({"key": names[i : i + 10_000], "vector": list(x[i : i + 10_000].astype(float))})

        rows = spark.read.format("binaryFile").load(path).select("content").mapInPandas(load, "key string, vector array<double>")
    return rows if keys is None else rows.join(keys.select(F.col("key").cast("string").alias("_k")).distinct(), F.col("key") == F.col("_k"), "left_semi")
