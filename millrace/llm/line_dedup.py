"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A document is its sequence of non-blank lines, each a 64-bit hash. Every run of ``k``
lines is a gram; of each ``w`` consecutive grams the smallest (leftmost on ties) is a
fingerprint. Two equal runs of ``w + k - 1`` lines or more so share a fingerprint at the
same place. Only the selected grams become rows, one each, with the lines around them that the windows
they stand for hold. Fingerprints that occur once in the corpus drop out. The positions of the
others are joined and extended both ways, over the lines before and after that their windows reach: an
extension that also starts earlier (by doc_id, then line) is a match, and adjacent matches make up
one maximal run. Later runs are deleted; the first occurrence stays whole. Content counts beside
lines: a single line of ``ALONE`` bytes or more is a run too, its own window and fingerprint, also
where it is all a document has.

Fingerprints and extensions are counted with partial aggregates, so that a line shared by a third of
all documents is one row per map task there; in the joins back the frequent ones, a list of bounded
length, are sent to the tasks, so that their rows stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

K, W = 1, 2
ALONE = 100


def _sequences(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc_id, fp, ln, h, size): numbers, hashes and bytes of the non-blank lines."""
    base = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).where("text is not null")
    lines = base.select("doc_id", F.xxhash64("text").alias("fp"), F.split("text", "\n", -1).alias("lines"))
    numbered = lines.select("doc_id", "fp", F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.octet_length(F.trim(x)).alias("size"), (F.length(F.trim(x)) > 0).alias("full"))), lambda s: s["full"]).alias("seq"))
    return numbered.select("doc_id", "fp", F.col("seq.i").alias("ln"), F.col("seq.h").alias("h"), F.col("seq.size").alias("size"))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, w: int = W, alone: int | None = ALONE) -> DataFrame:
    """(doc_id, fp, print, reach): each selected gram and each line of `alone` bytes; reach: first line, lines and hash of the windows it stands for."""
    t = w + k - 1
    seq = _sequences(docs, text, key)
    seq = seq.where(F.size("h") >= t) if alone is None else seq.where((F.size("h") >= t) | F.exists("size", lambda n: n >= alone))
    if k > 1:
        grams = F.when(F.size("h") >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.size("h") - (k - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("h", i, k))))
        seq = seq.withColumn("g", grams)
    else:
        seq = seq.withColumn("g", F.col("h"))
    last = F.greatest(F.size("h") - t, F.lit(0))
    # of each window the place of its fingerprint
    chosen = F.transform(F.sequence(F.lit(0), last), lambda i: _let(F.slice("g", i + 1, w), lambda g: i + F.array_position(g, F.array_min(g)).cast("int") - 1))

    def reach(j, places):
        around = F.filter(F.sequence(F.greatest(j - (w - 1), F.lit(0)), F.least(j, last)), lambda i: F.get(places, i) == j)
        return F.transform(around, lambda i: F.struct(i.alias("i"), F.lit(t).alias("t"), F.xxhash64(F.slice("h", i + 1, t)).alias("win")))

    each = _let(chosen, lambda places: F.transform(F.array_distinct(places), lambda j: F.struct(F.get("g", j).alias("print"), reach(j, places).alias("reach"))))
    if alone is not None:
        lines = F.transform("h", lambda h, i: F.struct(F.xxhash64(h, F.lit("alone")).alias("print"), F.array(F.struct(i.alias("i"), F.lit(1).alias("t"), h.alias("win"))).alias("reach")))
        lines = F.filter(lines, lambda x: F.get("size", F.get(x["reach"], 0)["i"]) >= alone)
        each = F.when(F.size("h") >= t, F.concat(each, lines)).otherwise(lines)
    return seq.select("doc_id", "fp", F.explode(each).alias("x")).select("doc_id", "fp", "x.print", "x.reach")


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, w: int = W, alone: int | None = ALONE) -> DataFrame:
    """(_mr_d, _mr_f, _mr_cut): of each document that loses some, the numbers of its lines in later repeats."""
    marks = C.materialize(fingerprints(docs, text, key, k, w, alone), "fingerprints")
    shared = C.materialize(marks.groupBy(F.col("print").alias("p")).agg(F.count("*").alias("c")).where("c > 1"), "shared")
    seeds = C.join_counted(marks, shared, "print", "p", "c", "left_semi").select("doc_id", "fp", F.explode("reach").alias("x"))
    seeds = C.materialize(seeds.select("doc_id", "fp", "x.i", "x.t", "x.win"), "seeds")
    place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), F.col("fp"), F.col("i"))
    first = seeds.groupBy(F.col("win").alias("q")).agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1")
    later = C.join_counted(seeds, C.materialize(first, "first"), "win", "q", "c").where(place > F.col("first"))
    starts = later.groupBy(F.col("doc_id").alias("_mr_d"), F.col("fp").alias("_mr_f")).agg(F.collect_set(F.struct("i", "t")).alias("starts"))
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda x: F.sequence(x["i"], x["i"] + x["t"] - 1))))
    return starts.select("_mr_d", "_mr_f", gone.alias("_mr_cut"))


def count_names(columns: list[str]) -> tuple[str, str]:
    """What `line_dedup` names its counts for a table of these columns: _mr_lines and _mr_gone, with more marks if it has them."""
    return C.free(columns, "_mr_lines"), C.free(columns, "_mr_gone")


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K, w: int = W, alone: int | None = ALONE) -> DataFrame:
    """docs with later repeated runs of `w + k - 1` or more non-blank lines, or of one line of
    `alone` bytes or more (none if it is None), cut from `text`, and lines before and lines deleted (`count_names`).

    Blank lines stay and do not break runs. Null texts stay null. Rows that repeat an id
    and a text have one place between them, so they all stay and lose what an earlier
    document holds. A null id sorts last. All other columns pass through, whatever their names.
    """
    names = [C.free(docs.columns, n) for n in ("_mr_d", "_mr_f", "_mr_cut", "_mr_x")]
    d, f, cut_, x = names
    n_lines, n_gone = count_names(docs.columns)
    gone = repeated_lines(docs, text, key, k, w, alone).toDF(d, f, cut_)
    own = F.col(f"`{text}`").cast("string")
    both = docs.join(gone, F.col(f"`{key}`").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(own) == F.col(f)), "left")
    lines = F.split(own, "\n", -1)

    def kept(ls):
        """The lines that stay. Cuts count non-blank lines only; each value is bound once, as lambdas would compute it per element."""
        numbers = F.sequence(F.lit(0), F.size(ls) - 1)
        full = F.filter(numbers, lambda i: F.length(F.trim(F.get(ls, i))) > 0)
        cut = _let(full, lambda f: F.transform(cut_, lambda i: F.get(f, i.cast("int"))))
        return _let(F.array_except(numbers, cut), lambda keep: F.array_join(F.transform(keep, lambda i: F.get(ls, i)), "\n"))

    new = F.when(F.col(cut_).isNull(), own).otherwise(_let(lines, kept))
    found = F.struct(new.alias("text"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("lines"), F.coalesce(F.size(cut_), F.lit(0)).cast("long").alias("gone"))
    # a generator of one row: what reads the new text reads its value and not its expression
    cols = [f"`{c}`" for c in docs.columns]
    both = both.select(*cols, F.explode(F.array(found)).alias(x))
    return both.select(*(F.col(f"{x}.text").alias(c) if c.lower() == text.lower() else F.col(f"`{c}`") for c in docs.columns), F.col(f"{x}.lines").alias(n_lines), F.col(f"{x}.gone").alias(n_gone))


def _let(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), lambda x: use(x)), 0)


def op1_line_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = line_dedup(docs)
    return out.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.col("_mr_lines")).alias("n_lines"), F.col("_mr_gone").alias("n_removed"), F.md5("text").alias("kept_md5"))


QUERIES = {"op1_line_dedup": op1_line_dedup}
SQL = {
    "op1_line_dedup": """
WITH l AS MATERIALIZED (SELECT doc_id, i, line, trim(line) <> '' AS full_ FROM (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))),
s AS MATERIALIZED (SELECT doc_id, i, line, lead(line) OVER o AS next_line, lead(i) OVER o AS next_i FROM l WHERE full_ WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT line, next_line, min((doc_id, i)) AS first_ FROM s WHERE next_i IS NOT NULL GROUP BY 1, 2),
m AS (SELECT s.doc_id, s.i, s.next_i FROM s JOIN f ON s.line = f.line AND s.next_line = f.next_line WHERE s.next_i IS NOT NULL AND (s.doc_id, s.i) > f.first_),
a AS (SELECT line, min((doc_id, i)) AS first_ FROM l WHERE strlen(trim(line)) >= 100 GROUP BY line),
g AS (SELECT DISTINCT doc_id, i FROM (SELECT doc_id, i FROM m UNION ALL SELECT doc_id, next_i FROM m UNION ALL SELECT l.doc_id, l.i FROM l JOIN a ON l.line = a.line WHERE (l.doc_id, l.i) > a.first_))
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.gone, 0) AS BIGINT) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.kept, '')) END AS kept_md5
FROM documents d LEFT JOIN (SELECT l.doc_id, count(*) AS n, count(g.i) AS gone, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS kept
  FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id) k ON k.doc_id = d.doc_id
"""
}
