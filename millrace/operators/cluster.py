"""Clustering of pairs' distances within blocks, and what surrounds it.

A block's distances go to one task as a list; blocks are bounded by `entities.subblocks`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.graph import connected_components

LINKAGES = ("average", "single", "complete", "weighted", "centroid", "median", "ward")


def merge_tree(d: np.ndarray, linkage: str = "average") -> list[tuple[int, int, float]]:
    """Merges (i, j, distance) of agglomerative clustering over a full distance matrix, by Lance-Williams updates; i keeps the merged cluster."""
    n = len(d)
    d = d.astype(float).copy()
    squared = linkage in ("centroid", "median", "ward")
    if squared:
        d = d * d
    np.fill_diagonal(d, np.inf)
    size = np.ones(n)
    alive = np.ones(n, bool)
    near = d.argmin(1) if n > 1 else np.zeros(n, int)
    out = []
    for _ in range(n - 1):
        rows = np.flatnonzero(alive)
        i = rows[d[rows, near[rows]].argmin()]
        j = near[i]
        if j < i:
            i, j = j, i
        dij = d[i, j]
        out.append((int(i), int(j), float(np.sqrt(dij)) if squared else float(dij)))
        a, b, s, t = d[i], d[j], size[i], size[j]
        if linkage == "average":
            new = (s * a + t * b) / (s + t)
        elif linkage == "single":
            new = np.minimum(a, b)
        elif linkage == "complete":
            new = np.maximum(a, b)
        elif linkage == "weighted":
            new = (a + b) / 2
        elif linkage == "centroid":
            new = (s * a + t * b) / (s + t) - s * t * dij / (s + t) ** 2
        elif linkage == "median":
            new = (a + b) / 2 - dij / 4
        elif linkage == "ward":
            new = ((s + size) * a + (t + size) * b - size * dij) / (s + t + size)
        else:
            raise ValueError(f"unknown linkage {linkage}")
        new[~alive] = np.inf
        new[[i, j]] = np.inf
        d[i], d[:, i] = new, new
        d[j], d[:, j] = np.inf, np.inf
        alive[j] = False
        size[i] += size[j]
        rows = np.flatnonzero(alive)
        if len(rows) > 1:
            near[i] = d[i].argmin()
            stale = rows[(near[rows] == i) | (near[rows] == j)]
            near[stale] = d[stale].argmin(1)
            closer = rows[d[rows, i] < d[rows, near[rows]]]
            near[closer] = i
    return out


def flat_clusters(d: np.ndarray, eps: float, linkage: str = "average") -> np.ndarray:
    """Labels of the clusters whose merges all lie within eps; the label is the smallest member's place."""
    n = len(d)
    label = np.arange(n)
    worst = np.zeros(n)  # the largest merge below each cluster
    for i, j, x in merge_tree(d, linkage):
        a, b = label == label[i], label == label[j]
        top = max(x, worst[label[i]], worst[label[j]])
        if top <= eps:
            root = min(label[i], label[j])
            label[a | b] = root
            worst[root] = top
        else:
            worst[[label[i], label[j]]] = np.inf  # no merge above a wide one counts
    return label


def agglomerate(rows: DataFrame, distances: DataFrame, eps: float = 0.5, linkage: str = "average", missing: float = 1.0) -> DataFrame:
    """(block, id, cluster): clusters of each block's rows (block, id) from distances (block, a, b, d).

    Pairs without a distance count as `missing`; blocks of one row are a cluster of one. cluster: the smallest id."""

    def solve(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(left["id"].unique())
        d = np.full((len(ids), len(ids)), missing)
        a, b = np.searchsorted(ids, right["a"].to_numpy()), np.searchsorted(ids, right["b"].to_numpy())
        d[a, b] = d[b, a] = right["d"].to_numpy()
        np.fill_diagonal(d, 0)
        label = flat_clusters(d, eps, linkage) if len(ids) else np.zeros(0, int)
        return pd.DataFrame({"block": [key[0]] * len(ids), "id": ids, "cluster": ids[label]})

    kind = dict(rows.dtypes)
    return rows.select("block", "id").groupBy("block").cogroup(distances.groupBy("block")).applyInPandas(solve, f"block {kind['block']}, id {kind['id']}, cluster {kind['id']}")


def final_distance(supervision, constraint, model):
    """What is known of a pair, in order: a label, a rule, the model."""
    return F.coalesce(supervision, constraint, model)


def logistic_distance(weights: dict[str, float], bias: float):
    """1 - P(same) of a weighted logistic scorer over feature columns; missing features count as 0."""
    z = F.lit(float(bias))
    for name, w in sorted(weights.items()):
        z = z + F.coalesce(F.col(name), F.lit(0.0)) * float(w)
    return 1 - 1 / (1 + F.exp(-z))


def vote(scores: list, weights: list[float] | None = None, hard: bool = False):
    """Weighted mean of scores, or the weighted majority of their halves (ties to 0)."""
    weights = weights or [1.0] * len(scores)
    total = float(sum(weights))
    terms = [F.when(s > 0.5, 1.0).otherwise(0.0) if hard else s for s in scores]
    mean = sum((t * w for t, w in zip(terms, weights)), F.lit(0.0)) / total
    return F.when(mean > 0.5, 1.0).otherwise(0.0) if hard else mean


def merge_seeded(clusters: DataFrame, require: DataFrame, disallow: DataFrame | None = None) -> DataFrame:
    """clusters (id, cluster) with those that share a required seed (id, seed) merged into the smallest; ids in any disallowed pair (a, b) do not pull."""
    pull = require
    if disallow is not None:
        bad = disallow.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        pull = pull.join(bad, "id", "left_anti")
    links = pull.join(clusters, "id").select("cluster", "seed").distinct()
    # the clusters of a seed are joined to the smallest of them
    first = links.groupBy("seed").agg(F.min("cluster").alias("b"))
    edges = links.join(first, "seed").select(F.col("cluster").alias("a"), "b")
    label = connected_components(edges, "seeds").select(F.col("node").alias("cluster"), F.col("comp").alias("root"))
    return clusters.join(label, "cluster", "left").select("id", F.coalesce("root", "cluster").alias("cluster"))


def rounded(x, places: int = 9):
    """Doubles rounded half away from zero as scaled doubles, which is what SQL's round does on them; F.round takes their shortest decimals instead, and halves then differ."""
    scaled = F.abs(x) * float(10**places)
    down = F.floor(scaled).cast("double")
    # beyond 2^52 there are no fractions
    return F.when(scaled < float(2**52), F.signum(x) * F.when(scaled - down >= 0.5, down + 1).otherwise(down) / float(10**places)).otherwise(x)


def assign_incremental(distances: DataFrame, groups: DataFrame, eps: float = 0.5) -> DataFrame:
    """(id, cluster): new ids with the old cluster they join, NULL for none.

    distances: (id, cluster, d) of new ids to members of old clusters; groups: (id, grp), the new ids' own clusters. Means per id and
    cluster, then the mean of these over each group; the nearest cluster strictly within eps, ties to the smallest."""
    # rounded, so that the order in which doubles are summed decides no tie
    mean = rounded(F.avg("d")).alias("d")
    per_id = distances.groupBy("id", "cluster").agg(mean)
    per_group = groups.join(per_id, "id").groupBy("grp", "cluster").agg(mean).where(F.col("d") < eps)
    best = per_group.groupBy("grp").agg(F.min(F.struct("d", "cluster")).alias("best")).select("grp", F.col("best.cluster").alias("cluster"))
    return groups.join(best, "grp", "left").select("id", "cluster")


def name_guard(assigned: DataFrame, names: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Assignments (id, cluster) taken back (to NULL) where the cluster has first names of two letters or more and none is prefix-compatible or a
    known alias (name_a, name_b: the member's, the new one's); names: (id, cluster, first) of new ids (cluster NULL) and members."""
    from millrace.functions.text import same_prefix_tokens

    members = names.where("cluster is not null and length(first) > 1").select("cluster", F.col("first").alias("known")).distinct()
    new = assigned.where("cluster is not null").join(names.where("cluster is null").select("id", "first"), "id")
    pairs = new.join(members, "cluster")
    ok = same_prefix_tokens(F.col("known"), F.col("first"))
    if aliases is not None:
        told = aliases.select(F.col("name_a").alias("_a"), F.col("name_b").alias("_b")).distinct()
        pairs = pairs.join(told, (F.col("known") == F.col("_a")) & (F.col("first") == F.col("_b")), "left")
        ok = ok | F.col("_a").isNotNull()
    fits = pairs.groupBy("id", "cluster").agg(F.max(ok).alias("ok"))
    return assigned.join(fits, ["id", "cluster"], "left").select("id", F.when(F.coalesce("ok", F.lit(True)), F.col("cluster")).alias("cluster"))


def tune_eps(rows: DataFrame, distances: DataFrame, truth: DataFrame, grid: tuple[float, ...] = tuple(i / 20 for i in range(1, 20)), linkage: str = "average") -> DataFrame:
    """(eps, f1): B-cubed of each threshold of a grid, best first; one clustering pass labels all thresholds."""
    from millrace.operators.metrics import b_cubed

    def solve(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        ids = np.sort(left["id"].unique())
        d = np.full((len(ids), len(ids)), 1.0)
        a, b = np.searchsorted(ids, right["a"].to_numpy()), np.searchsorted(ids, right["b"].to_numpy())
        d[a, b] = d[b, a] = right["d"].to_numpy()
        np.fill_diagonal(d, 0)
        return pd.concat([pd.DataFrame({"eps": e, "id": ids, "cluster": ids[flat_clusters(d, e, linkage)]}) for e in grid])

    kind = dict(rows.dtypes)
    found = rows.select("block", "id").groupBy("block").cogroup(distances.groupBy("block")).applyInPandas(solve, f"eps double, id {kind['id']}, cluster {kind['id']}")
    scored = found.join(truth.select("id", F.col("cluster").alias("true")), "id").select("eps", F.col("id").alias("item"), "true", F.col("cluster").alias("pred"))
    return b_cubed(scored, ("eps",), 6).select("eps", "f1").orderBy(F.desc("f1"), "eps")


def greedy_merge(parts: DataFrame, scores: DataFrame, maximum: int) -> DataFrame:
    """(block, part, merged): parts (block, part, n) joined while they fit `maximum`, best score first; scores: (block, p, q, score), ties by names."""

    def solve(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        root = {p: p for p in left["part"]}
        size = dict(zip(left["part"], left["n"]))

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for _, p, q in sorted(zip(-right["score"], right["p"], right["q"])):
            if p in root and q in root:
                a, b = sorted((find(p), find(q)))
                if a != b and size[a] + size[b] <= maximum:
                    root[b] = a
                    size[a] += size[b]
        return pd.DataFrame({"block": key[0], "part": list(root), "merged": [find(p) for p in root]})

    return parts.groupBy("block").cogroup(scores.groupBy("block")).applyInPandas(solve, "block string, part string, merged string")


def same_orcid_home(rows: DataFrame) -> DataFrame:
    """rows (id, orcid, part) with all ids of an ORCID in the part that holds most of them, ties to the smallest."""
    most = rows.where("orcid is not null").groupBy("orcid", "part").agg(F.count("*").alias("n")).groupBy("orcid").agg(F.min(F.struct((-F.col("n")).alias("n"), "part")).alias("home"))
    return rows.join(most, "orcid", "left").select("id", "orcid", F.coalesce("home.part", "part").alias("part"))


def rank_in_block(rows: DataFrame, block: str, *order) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(block).orderBy(*order)))
