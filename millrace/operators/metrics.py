"""Cluster and pair metrics from contingency counts: nothing is enumerated pair by pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import f1


def _contingency(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    cell = rows.groupBy(*by, "true", "pred").agg(F.count("*").alias("n"))
    t = cell.groupBy(*by, "true").agg(F.sum("n").alias("nt"))
    p = cell.groupBy(*by, "pred").agg(F.sum("n").alias("np"))
    return cell.join(t, [*by, "true"]).join(p, [*by, "pred"])


def b_cubed(rows: DataFrame, by: tuple[str, ...] = (), digits: int = 3) -> DataFrame:
    """(precision, recall, f1) of items (item, true, pred), macro over items, rounded half to even."""
    c = _contingency(rows, by)
    out = c.groupBy(*by).agg((F.sum(F.col("n") * F.col("n") / F.col("np")) / F.sum("n")).alias("p"), (F.sum(F.col("n") * F.col("n") / F.col("nt")) / F.sum("n")).alias("r"))
    return out.select(*by, *(F.bround(c, digits).alias(n) for n, c in (("precision", F.col("p")), ("recall", F.col("r")), ("f1", f1(F.col("p"), F.col("r"))))))


def b_cubed_items(rows: DataFrame, skip: DataFrame | None = None) -> DataFrame:
    """(item, precision, recall, f1, pred_bigger, true_bigger) per item; `skip` lists items that do not count."""
    c = _contingency(rows).select("true", "pred", "n", "nt", "np")
    out = rows.join(c, ["true", "pred"])
    if skip is not None:
        out = out.join(skip, "item", "left_anti")
    p, r = F.col("n") / F.col("np"), F.col("n") / F.col("nt")
    return out.select("item", p.alias("precision"), r.alias("recall"), f1(p, r).alias("f1"), F.when(F.col("np") >= F.col("nt"), F.col("np") / F.col("nt")).alias("pred_bigger"), F.when(F.col("np") < F.col("nt"), F.col("nt") / F.col("np")).alias("true_bigger"))


def pairwise_prf(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(precision, recall, f1) over pairs of items in one cluster; a cluster of one counts as the pair with itself."""
    c = _contingency(rows, by)
    pairs = lambda n: n * (n - 1) / 2
    size = lambda n: F.when(n == 1, 1.0).otherwise(pairs(n))
    alone = (F.col("nt") == 1) & (F.col("np") == 1)
    shared = c.groupBy(*by).agg(F.sum(F.when(alone, 1.0).otherwise(pairs(F.col("n")))).alias("both"))
    gold = c.groupBy(*by, "true").agg(F.first("nt").alias("n")).groupBy(*by).agg(F.sum(size(F.col("n"))).alias("gold"))
    sys_ = c.groupBy(*by, "pred").agg(F.first("np").alias("n")).groupBy(*by).agg(F.sum(size(F.col("n"))).alias("sys"))
    j = shared.join(gold, list(by)).join(sys_, list(by)) if by else shared.crossJoin(gold).crossJoin(sys_)  # one row each without `by`
    p, r = F.col("both") / F.col("sys"), F.col("both") / F.col("gold")
    return j.select(*by, p.alias("precision"), r.alias("recall"), f1(p, r).alias("f1"))


def cmacro(rows: DataFrame, by: str) -> DataFrame:
    """Pairwise precision, recall and f1, averaged over blocks."""
    return pairwise_prf(rows, (by,)).agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1")))


def synonymity(rows: DataFrame) -> DataFrame:
    """Per item (item, true, name): homonymity, the share of items of its name in other clusters, and synonymity, the share of its cluster's items under other names; 2 digits, NULL where 0."""
    same = rows.groupBy("true", "name").agg(F.count("*").alias("n"))
    by_name = same.groupBy("name").agg(F.sum("n").alias("nn"))
    by_true = same.groupBy("true").agg(F.sum("n").alias("nc"))
    j = rows.join(same, ["true", "name"]).join(by_name, "name").join(by_true, "true")
    share = lambda part, all_: F.when(part > 0, F.bround(part / all_, 2))
    return j.select("item", share(F.col("nn") - F.col("n"), F.col("nn")).alias("homonymity"), share(F.col("nc") - F.col("n"), F.col("nc")).alias("synonymity"))


def facets(items: DataFrame, scores: DataFrame, names: list[str]) -> DataFrame:
    """(facet, value, n, f1): mean score by each facet's value, in one pass over unpivoted facets."""
    long = items.join(scores, "item").select("f1", F.explode(F.array(*(F.struct(F.lit(n).alias("facet"), F.col(n).cast("string").alias("value")) for n in names))).alias("x")).select("x.*", "f1")
    return long.where("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"), F.avg("f1").alias("f1"))


def claims(labelled: DataFrame, clusters: DataFrame) -> DataFrame:
    """(tp, fp, tn, fn, precision, recall, accuracy) of labelled pairs (a, b, label) against clusters (item, pred); pairs with an unknown item are skipped."""
    c = clusters.select("item", "pred")
    j = labelled.join(c.select(F.col("item").alias("a"), F.col("pred").alias("pa")), "a").join(c.select(F.col("item").alias("b"), F.col("pred").alias("pb")), "b")
    same, yes = F.col("pa") == F.col("pb"), F.col("label") == 1
    n = j.agg(F.count_if(same & yes).alias("tp"), F.count_if(same & ~yes).alias("fp"), F.count_if(~same & ~yes).alias("tn"), F.count_if(~same & yes).alias("fn"))
    return n.select("*", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"), F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("accuracy"))


def ranking(scored: DataFrame) -> DataFrame:
    """(auroc, average_precision) of rows (label, score), ties taken together.

    Counts per score first; the running sums go over the distinct scores only."""
    s = scored.groupBy("score").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") != 1).alias("q"))
    w = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = s.withColumn("tp", F.sum("p").over(w)).withColumn("fp", F.sum("q").over(w))
    total = run.agg(F.sum("p").alias("np"), F.sum("q").alias("nq"), F.sum(F.col("q") * (F.col("tp") - F.col("p") / 2)).alias("area"), F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("ap"))
    return total.select(F.try_divide(F.col("area"), F.col("np") * F.col("nq")).alias("auroc"), F.try_divide("ap", "np").alias("average_precision"))


def threshold_prf(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Macro precision, recall and f1 over both labels at a threshold."""
    hit, yes = F.col("score") > threshold, F.col("label") == 1
    n = scored.agg(F.count_if(hit & yes).alias("tp"), F.count_if(hit & ~yes).alias("fp"), F.count_if(~hit & ~yes).alias("tn"), F.count_if(~hit & yes).alias("fn"))
    z = lambda c: F.coalesce(c, F.lit(0.0))
    p1, r1 = z(F.try_divide("tp", F.col("tp") + F.col("fp"))), z(F.try_divide("tp", F.col("tp") + F.col("fn")))
    p0, r0 = z(F.try_divide("tn", F.col("tn") + F.col("fn"))), z(F.try_divide("tn", F.col("tn") + F.col("fp")))
    return n.select(((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"), ((z(f1(p0, r0)) + z(f1(p1, r1))) / 2).alias("f1"))


def bins(value, edges: list[float]):
    """Right-closed interval number of a value: edges[i] < value <= edges[i + 1]; NULL outside."""
    out = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        out = F.when((value > lo) & (value <= hi), i).otherwise(out)
    return out


def min_pair_edits(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """(true, misplaced): per true cluster, items outside its largest predicted part: the relabels that a perfect clustering needs; edges (a, b, label) give how many labelled pairs each touches."""
    cell = rows.groupBy("true", "pred").agg(F.count("*").alias("n"))
    best = cell.groupBy("true").agg(F.max_by("pred", F.struct("n", "pred")).alias("main"))
    off = rows.join(best, "true").where("pred <> main").select("item", "true")
    touched = off.join(edges.select(F.explode(F.array("a", "b")).alias("item")), "item", "left_semi")
    return best.select("true").join(off.groupBy("true").agg(F.count("*").alias("misplaced")), "true", "left").join(touched.groupBy("true").agg(F.count("*").alias("touched")), "true", "left").na.fill(0)


#: Facets that scores are broken down by.
FACETS = "gender ethnicity n_authors year block_size cluster_size homonymity synonymity first_name affiliation email abstract venue references multiple_authors".split()


def signature_facets(signatures: DataFrame, papers: DataFrame, clusters: DataFrame, block: str = "block") -> DataFrame:
    """(item, facets...) of prepared signatures that have a true cluster; clusters: (cluster_id, signature_id).

    Homonymity and synonymity are shares of the other rows of the block: with the same full name in another cluster, and
    under another name in the same cluster, with two digits, NULL where there are none. They come from counts, no pair is made.
    Block and cluster sizes count all rows, with a true cluster or not. Columns gender and ethnicity may be missing."""
    from millrace.functions.text import full_name

    have = set(signatures.columns)
    told = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    filled = lambda c: F.coalesce(F.length(F.col(c)) > 0, F.lit(False))
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    sizes = signatures.groupBy(F.col(block).alias("_b")).agg(F.count("*").alias("block_size"))
    members = clusters.select("cluster_id", F.col("signature_id").alias("_s"))
    larger = members.groupBy(F.col("cluster_id").alias("_c")).agg(F.count("*").alias("cluster_size"))
    name = full_name(F.col("first_n"), F.col("middle_n"), F.col("last_n"), F.col("suffix"))
    paper = papers.select(F.col("paper_id").alias("_p"), F.size("authors").alias("n_authors"), "year", F.col("has_abstract").alias("_a"), (filled("venue") | filled("journal_name")).alias("_v"), some("references").alias("_r"))
    rows = signatures.join(members, F.col("signature_id") == F.col("_s")).join(paper, F.col("paper_id") == F.col("_p")).join(sizes, F.col(block) == F.col("_b")).join(larger, F.col("cluster_id") == F.col("_c")).withColumn("_n", name)
    cell = rows.groupBy("_b", "_n", "cluster_id").agg(F.count("*").alias("_bnc"))
    by_name = cell.groupBy("_b", "_n").agg(F.sum("_bnc").alias("_bn"))
    by_cluster = cell.groupBy("_b", "cluster_id").agg(F.sum("_bnc").alias("_bc"))
    by_block = cell.groupBy("_b").agg(F.sum("_bnc").alias("_all"))
    rows = rows.join(cell, ["_b", "_n", "cluster_id"]).join(by_name, ["_b", "_n"]).join(by_cluster, ["_b", "cluster_id"]).join(by_block, "_b")
    share = lambda n: F.when(n > 0, F.bround(n / (F.col("_all") - 1), 2))
    flag = lambda c: c.cast("int")
    return rows.select(
        F.col("signature_id").alias("item"), told("gender").alias("gender"), F.left(told("ethnicity"), F.lit(3)).alias("ethnicity"), "n_authors", F.coalesce("year", F.lit(0)).alias("year"), "block_size", "cluster_size",
        share(F.col("_bn") - F.col("_bnc")).alias("homonymity"), share(F.col("_bc") - F.col("_bnc")).alias("synonymity"),
        flag(F.coalesce(F.length(F.replace("first", F.lit("."), F.lit(""))) >= 2, F.lit(False))).alias("first_name"), flag(some("affiliations")).alias("affiliation"), flag(filled("email")).alias("email"),
        flag(F.col("_a")).alias("abstract"), flag(F.col("_v")).alias("venue"), flag(F.col("_r")).alias("references"), flag(some("coauthors")).alias("multiple_authors"),
    )


def facet_eval(signatures: DataFrame, papers: DataFrame, clusters: DataFrame, scores: DataFrame, block: str = "block") -> DataFrame:
    """(facet, value, n, f1) of scores (item, f1) by all facets; a value that is missing does not count."""
    return facets(signature_facets(signatures, papers, clusters, block), scores, FACETS)
