"""Author names whose order a parser corrects: parsing by paper, the gate, and the overwrites.

Parses are rows (paper_id, position, given_tokens, surname_tokens, original_compound_surname, middle_tokens); the
parser is injected. Everything else is joins on (paper, position) and counts per name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

PARSE = "paper_id {key}, position int, given_tokens array<string>, surname_tokens array<string>, original_compound_surname string, middle_tokens array<string>"


def parse_names(papers: DataFrame, parser: Callable[[list[str]], list[dict | None]]) -> DataFrame:
    """Parses of all authors of papers (paper_id, authors), a paper's names at a time.

    parser: for each name None (not of the kind it knows) or {"parsed", "original_order"}, each with given_tokens,
    surname_tokens and, if there are any, middle_tokens, and original_compound_surname beside them. Where some names of a paper
    are not known, the others keep their original order. Names that are null are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, authors in zip(batch["paper_id"], batch["authors"]):
                named = [(a["position"], a["author_name"]) for a in (authors if authors is not None else []) if a["author_name"] is not None]
                found = parser([n for _, n in named]) if named else []
                which = "original_order" if any(x is None for x in found) else "parsed"
                for (position, _), x in zip(named, found):
                    parsed = x and x.get(which)
                    if parsed:
                        rows.append((key, position, list(parsed["given_tokens"]), list(parsed["surname_tokens"]), x.get("original_compound_surname"), list(parsed.get("middle_tokens") or [])))
            yield pd.DataFrame(rows, columns=["paper_id", "position", "given_tokens", "surname_tokens", "original_compound_surname", "middle_tokens"])

    return papers.select("paper_id", "authors").mapInPandas(run, PARSE.format(key=dict(papers.dtypes)["paper_id"]))


def parsed_name() -> Column:
    """struct(first, middle, last) of a parse: tokens joined by dashes (of the middle by spaces); a compound surname is kept as it was."""
    filled = lambda c: F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))
    compound = F.trim(F.coalesce("original_compound_surname", F.lit("")))
    last = F.when(compound != "", compound).otherwise(F.array_join(filled("surname_tokens"), "-"))
    return F.struct(F.array_join(filled("given_tokens"), "-").alias("first"), F.array_join(filled("middle_tokens"), " ").alias("middle"), last.alias("last"))


def _named(signatures: DataFrame) -> DataFrame:
    """signatures plus the name as it stands: _first, _last and _name."""
    first = T.split_first_middle(F.coalesce("first", F.lit("")), F.coalesce("middle", F.lit("")))["first"]
    last = T.normalize_text(F.col("last"))
    return signatures.withColumn("_first", first).withColumn("_last", last).withColumn("_name", F.trim(F.concat_ws(" ", "_first", "_last")))


def overwrite_gate(signatures: DataFrame, parses: DataFrame, ratio: float = 3.0) -> DataFrame:
    """(paper_id, position) whose names may be overwritten: all places of names that qualify.

    Per name, parses that turn it around (x) and that do not (y) on papers with several signed positions decide by
    x >= ratio * y where there are any; else one turn among the papers with one position is enough."""
    several = signatures.groupBy(F.col("paper_id").alias("_p")).agg(F.min("position").alias("_a"), F.max("position").alias("_b")).select("_p", (F.col("_a") != F.col("_b")).alias("_many"))
    named = _named(signatures)
    told = parses.select(F.col("paper_id").alias("_q"), F.col("position").alias("_pos"), parsed_name().alias("_n")).where("_n.first <> '' and _n.last <> ''")
    letters = lambda c: F.regexp_replace(F.lower(c), "[^a-z]", "")
    turned = (letters(F.col("_n.first")) == letters(F.col("_last"))) & (letters(F.col("_n.last")) == letters(F.col("_first")))
    rows = named.join(told, (F.col("paper_id") == F.col("_q")) & (F.col("position") == F.col("_pos"))).join(several, F.col("paper_id") == F.col("_p"))
    stat = rows.groupBy(F.col("_name").alias("_k")).agg(F.count_if(F.col("_many") & turned).alias("x"), F.count_if(F.col("_many") & ~turned).alias("y"), F.count_if(~F.col("_many") & turned).alias("a"))
    good = stat.where(F.when(F.col("x") + F.col("y") > 0, F.col("x") >= ratio * F.col("y")).otherwise(F.col("a") > 0)).select("_k")
    return named.join(good, F.col("_name") == F.col("_k"), "left_semi").select("paper_id", "position").distinct()


def _allowed(parses: DataFrame, allow: DataFrame | None) -> DataFrame:
    return parses if allow is None else parses.join(allow, ["paper_id", "position"], "left_semi")


def overwrite_signatures(signatures: DataFrame, parses: DataFrame, allow: DataFrame | None = None, blocks: bool = False) -> DataFrame:
    """signatures with first, middle and last of their parse, where there is one that names something, and `overwritten`.

    blocks: also a new `block` of initial and surname, without spaces and dashes, where both are there (for inference: it moves rows)."""
    told = _allowed(parses, allow).select(F.col("paper_id").alias("_p"), F.col("position").alias("_q"), parsed_name().alias("_n")).where("_n.first <> '' or _n.last <> ''")
    rows = signatures.join(told, (F.col("paper_id") == F.col("_p")) & (F.col("position") == F.col("_q")), "left")
    hit = F.col("_n").isNotNull()
    new = {c: F.when(hit, F.col(f"_n.{c}")).otherwise(F.col(c)) for c in ("first", "middle", "last")}
    if blocks:
        block = F.trim(F.concat_ws(" ", F.lower(F.left("_n.first", F.lit(1))), F.regexp_replace(F.lower("_n.last"), r"[\s-]+", "")))
        new["block"] = F.when(hit & (F.col("_n.first") != "") & (F.col("_n.last") != ""), block).otherwise(F.col("block"))
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in signatures.columns), hit.alias("overwritten"))


def overwrite_papers(papers: DataFrame, parses: DataFrame, allow: DataFrame | None = None) -> DataFrame:
    """papers whose authors carry the names of their parses, and `n_overwritten`, the number that changed."""
    whole = F.array_join(F.filter(F.array("_n.first", "_n.middle", "_n.last"), lambda x: x != ""), " ")
    told = _allowed(parses, allow).select(F.col("paper_id").alias("_p"), "position", parsed_name().alias("_n")).select("_p", "position", whole.alias("name")).where("name <> ''")
    told = told.groupBy("_p").agg(F.map_from_entries(F.collect_list(F.struct("position", "name"))).alias("_names"))
    rows = papers.join(told, F.col("paper_id") == F.col("_p"), "left").withColumn("_names", F.coalesce("_names", F.create_map().cast("map<int,string>")))
    name = lambda a: F.coalesce(F.element_at("_names", a["position"].cast("int")), a["author_name"])
    authors = F.transform("authors", lambda a: F.struct(a["position"].alias("position"), name(a).alias("author_name")))
    changed = F.size(F.filter("authors", lambda a: F.coalesce(name(a) != a["author_name"], F.element_at("_names", a["position"].cast("int")).isNotNull())))
    return rows.select(*(authors.alias("authors") if c == "authors" else F.col(c) for c in papers.columns), changed.alias("n_overwritten"))
