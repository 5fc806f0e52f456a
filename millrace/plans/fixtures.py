"""Code- and author-shaped inputs derived from the star schema, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import table

#: One line of code per order, in a dialect that both engines read.
CODE_LINE = """CASE o_orderkey % 17
 WHEN 0 THEN 'import os' WHEN 1 THEN 'from pkg.f' || CAST(o_custkey % 7 AS STRING) || ' import name'
 WHEN 2 THEN CASE o_custkey % 3 WHEN 0 THEN 'k = os.getenv("APP_' || CAST(o_custkey % 9 AS STRING) || '")' WHEN 1 THEN 'k = os.environ.get("B_' || CAST(o_custkey % 9 AS STRING) || '", 1)' ELSE 'k = os.environ["C_X"]' END
 WHEN 3 THEN 'def run_' || CAST(o_orderkey % 11 AS STRING) || '(x):' WHEN 4 THEN CASE WHEN o_custkey % 2 = 0 THEN '    \"\"\"Docs.' ELSE '    \"\"\"' END
 WHEN 5 THEN '    raise ValueError(x)' WHEN 6 THEN '    assert x > ' || CAST(o_orderkey % 5 AS STRING) || ', "bad"' WHEN 7 THEN '    if x is None:' WHEN 8 THEN ' '
 WHEN 9 THEN 'logger.' || CASE o_custkey % 3 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' ELSE 'trace' END || '("first step")' WHEN 10 THEN 'if __name__ == "__main__":'
 WHEN 11 THEN 'def test_case_' || CAST(o_orderkey % 13 AS STRING) || '():' WHEN 12 THEN 'with open(p) as f:  # lazy cache' WHEN 13 THEN 'm = re.compile("a")'
 WHEN 14 THEN 'async def go_' || CAST(o_orderkey % 7 AS STRING) || '():' WHEN 15 THEN 'registry.register(batch)  # fallback policy' ELSE 'class Thing_' || CAST(o_orderkey % 3 AS STRING) || ':' END"""
CODE_PATH = "CASE WHEN o_custkey % 40 = 7 THEN 'pkg/__init__' WHEN o_custkey % 5 = 0 THEN 'tests/test_f' || CAST(o_custkey % 40 AS STRING) ELSE 'pkg/f' || CAST(o_custkey % 40 AS STRING) END || '.py'"
CODE_SQL = f"""code AS MATERIALIZED (SELECT path, line, text, count(*) OVER (PARTITION BY path) AS n FROM
 (SELECT {CODE_PATH} AS path, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) AS line, {CODE_LINE} AS text FROM orders))"""


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, text): forty source files."""
    rows = table(spark, sf_dir, "orders").select(F.expr(CODE_PATH).alias("path"), "o_orderkey", F.expr(CODE_LINE).alias("text"))
    files = rows.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "text"))).alias("x"))
    return files.select("path", F.array_join("x.text", "\n").alias("text"))


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text")


DOC_LINES_SQL = """dl AS MATERIALIZED (SELECT 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS path, unnest(range(1, len(ls) + 1)) AS line, unnest(ls) AS text, len(ls) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""

#: Authors: parts of orders; a part is the person, its name the author's name, an order the paper.
BIB_SQL = """bib AS MATERIALIZED (SELECT l_orderkey * 100000 + l_partkey AS sig, l_orderkey AS paper, l_partkey AS person, p_name AS name, min(l_linenumber) AS position, CAST(year(o_orderdate) AS INTEGER) AS year,
 substr(p_name, 1, 1) || ' ' || split_part(p_name, ' ', -1) AS block FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_partkey, p_name, o_orderdate)"""


def bibliography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sig, paper, person, name, position, year, block): one row per author of a paper."""
    from millrace.functions.text import compute_block

    lineitem, part, orders = (table(spark, sf_dir, t) for t in ("lineitem", "part", "orders"))
    j = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    g = j.groupBy("l_orderkey", "l_partkey", "p_name", "o_orderdate").agg(F.min("l_linenumber").alias("position"))
    return g.select(
        (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("sig"), F.col("l_orderkey").alias("paper"), F.col("l_partkey").alias("person"), F.col("p_name").alias("name"), "position",
        F.year("o_orderdate").alias("year"), compute_block(F.col("p_name")).alias("block"),
    )
