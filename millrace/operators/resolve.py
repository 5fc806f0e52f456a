"""From author records to clusters: pairs, constraints, distances, clustering, seeds; whole or incremental.

A composition of the operators in `entities`, `cluster` and `metrics`; the scorer is any
column over the feature columns, by default a logistic one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import cluster as K
from millrace.operators import entities as N
from millrace.operators import metrics as M
from millrace.storage import materialize

#: Default scorer: features that speak for one person, and a bias.
WEIGHTS = {"first_names_equal": 1.5, "coauthor_match": 4.0, "affiliation_overlap": 2.0, "email_prefix_equal": 4.0, "title_overlap_words": 3.0, "venue_overlap": 1.0, "first_name_jaro": 1.0, "year_diff": -0.05}
BIAS = -2.5


def pair_distances(signatures: DataFrame, papers: DataFrame, scorer: Column | None = None, aliases: DataFrame | None = None, seeds: DataFrame | None = None, known: DataFrame | None = None, block: str = "block", references: bool = False, new: DataFrame | None = None) -> DataFrame:
    """(block, a, b, d) for all pairs in a block of prepared signatures: a known distance, else what a rule says, else the scorer.

    seeds: (a, b, kind) with kind require or disallow; known: (a, b, d); aliases: (name_a, name_b); new: (id), pairs without
    one of these are left out before anything is computed."""
    rows = signatures.join(papers.drop("authors"), "paper_id")
    if new is not None:
        rows = rows.join(new.select(F.col("id").alias("_new")).distinct(), F.col("signature_id") == F.col("_new"), "left")
    require = None if seeds is None else seed_groups(seeds)
    rows = rows.withColumn("seed", F.lit(None).cast("string")) if require is None else rows.join(require.select(F.col("id").alias("signature_id"), "seed"), "signature_id", "left")
    pairs = N.pairs_in_block(rows, block, "signature_id")
    if new is not None:
        pairs = pairs.where(F.col("_new_a").isNotNull() | F.col("_new_b").isNotNull())
    a, b = F.col("signature_id_a"), F.col("signature_id_b")
    if seeds is not None:
        bad = seeds.where("kind = 'disallow'").select(F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y")).distinct()
        pairs = pairs.join(bad, (a == F.col("_x")) & (b == F.col("_y")), "left").withColumn("disallowed", F.col("_x").isNotNull()).drop("_x", "_y")
    else:
        pairs = pairs.withColumn("disallowed", F.lit(False))
    pairs = N.with_aliases(pairs, aliases) if aliases is not None else pairs.withColumn("alias_hit", F.lit(False))
    if known is not None:
        told = known.select(F.least("a", "b").alias("_x"), F.greatest("a", "b").alias("_y"), F.col("d").alias("_d"))
        pairs = pairs.join(told, (a == F.col("_x")) & (b == F.col("_y")), "left").drop("_x", "_y")
    else:
        pairs = pairs.withColumn("_d", F.lit(None).cast("double"))
    scored = pairs.select(F.col(f"{block}_a").alias("block"), a.alias("a"), b.alias("b"), "_d", N.constraint(F.col("alias_hit")).alias("_c"), *N.pair_features(references))
    score = scorer if scorer is not None else K.logistic_distance(WEIGHTS, BIAS)
    return scored.select("block", "a", "b", K.final_distance(F.col("_d"), F.col("_c"), score).alias("d"))


def seed_groups(seeds: DataFrame) -> DataFrame:
    """(id, seed): ids of one required group share a seed, the smallest of its ids."""
    pairs = seeds.where("kind = 'require'").select("a", "b")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("cluster"))
    links = pairs.select(F.explode(F.array("a", "b")).alias("id"), F.concat_ws("\t", "a", "b").alias("seed"))
    return K.merge_seeded(ids, links).select("id", F.col("cluster").alias("seed"))


def resolve(signatures: DataFrame, papers: DataFrame, eps: float = 0.5, linkage: str = "average", seeds: DataFrame | None = None, maximum: int | None = None, **how) -> DataFrame:
    """(block, id, cluster) of prepared signatures, clusters with a required seed in common merged.

    maximum: blocks of more rows are parted by first names (`entities.bounded_blocks`), so that no task gets more than maximum
    squared distances; the parts with single letters join the other parts' clusters of their block afterwards, one row at a time
    or as groups, and only where a block has other parts."""
    block = how.pop("block", "block")
    rows = signatures.select(F.col(block).alias("block"), F.col("signature_id").alias("id"), F.col("first_n").alias("first"))
    if maximum is None:
        distances = pair_distances(signatures, papers, seeds=seeds, block=block, **how)
        found = K.agglomerate(rows, distances, eps, linkage)
    else:
        parts = materialize(N.bounded_blocks(rows, maximum).join(rows, "id").select("id", "part", "block", (F.length("first") <= 1).alias("single")), "parts")
        shapes = parts.groupBy("part", F.col("block").alias("_b")).agg(F.min("single").alias("letters"))
        lone = shapes.groupBy("_b").agg(F.min("letters").alias("only")).where("only")  # blocks of nothing but single letters
        later = shapes.where("letters").join(lone, "_b", "left_anti").select(F.col("part").alias("_p"))
        parts = materialize(parts.join(later, F.col("part") == F.col("_p"), "left").select("id", "part", "block", F.col("_p").isNotNull().alias("later")), "parts")
        sigs = signatures.drop("part").join(parts.select(F.col("id").alias("_i"), "part", "later"), F.col("signature_id") == F.col("_i")).drop("_i")
        early = sigs.where("not later")
        first = K.agglomerate(early.select(F.col("part").alias("block"), F.col("signature_id").alias("id")), pair_distances(early, papers, seeds=seeds, block="part", **how), eps, linkage)
        first = materialize(first.select("id", "cluster"), "first")
        # pairs of single letters with all of their block, but not of the others with each other
        late = parts.where("later").select("id")
        whole = predict_incremental(signatures, papers, first, late, eps=eps, linkage=linkage, block=block, parts=parts.where("later").select("id", "part"), seeds=seeds, **how)
        found = rows.select("block", "id").join(whole, "id").select("block", "id", "cluster")
    if seeds is None:
        return found
    disallow = seeds.where("kind = 'disallow'").select("a", "b")
    merged = K.merge_seeded(found.select("id", "cluster"), seed_groups(seeds), disallow)
    return found.select("block", "id").join(merged, "id").select("block", "id", "cluster")


def split_altered(signatures: DataFrame, papers: DataFrame, old: DataFrame, altered: DataFrame, eps: float, linkage: str, **how) -> DataFrame:
    """(id, cluster, part): old clusters, and of those that hold an altered id the parts that the model would make of them."""
    kind = dict(old.dtypes)["cluster"]
    hit = old.join(altered.select(F.col("id").alias("_i")).distinct(), F.col("id") == F.col("_i"), "left_semi").select("cluster").distinct()
    members = old.join(hit, "cluster", "left_semi").select(F.col("id").alias("_i"), F.col("cluster").alias("_claimed"))
    sigs = signatures.join(members, F.col("signature_id") == F.col("_i")).drop("_i")
    inside = K.agglomerate(sigs.select(F.col("_claimed").alias("block"), F.col("signature_id").alias("id")), pair_distances(sigs, papers, block="_claimed", **how), eps, linkage)
    inside = materialize(inside.select(F.col("id").alias("_i"), F.col("block").cast(kind).alias("_c"), F.col("cluster").alias("_part")), "inside")
    several = inside.groupBy("_c").agg(F.countDistinct("_part").alias("_k")).where("_k > 1").select(F.col("_c").alias("_s"))
    inside = inside.join(several, F.col("_c") == F.col("_s"), "left_semi").select("_i", "_part")
    return old.join(inside, F.col("id") == F.col("_i"), "left").select("id", "cluster", F.col("_part").cast("string").alias("part"))


def predict_incremental(
    signatures: DataFrame, papers: DataFrame, old: DataFrame, new: DataFrame, altered: DataFrame | None = None, eps: float = 0.5, linkage: str = "average", aliases: DataFrame | None = None,
    prevent_new_names: bool = True, parts: DataFrame | None = None, block: str = "block", **how,
) -> DataFrame:
    """(id, cluster) of all old and new ids: new ones join the old cluster that their group is nearest to, within eps, or make up new ones.

    old: (id, cluster); new: (id), those in old are left out. New rows are clustered among themselves first (within `parts` (id, part), if
    these are given), and a group joins as one. Old clusters that hold an `altered` id (id) are split as the model would split them while
    distances are taken, and are whole again in the result; a row that joins through a part is sent back if its first name
    goes with none of the whole cluster's. What joins nothing is clustered again; new clusters are called after their
    smallest id. Pairs of two old rows are never scored."""
    kind = dict(signatures.dtypes)["signature_id"]
    if dict(old.dtypes)["cluster"] != kind:  # new clusters are called after ids, so both are text then
        kind = "string"
        old = old.select("id", F.col("cluster").cast(kind).alias("cluster"))
    how = how | {"aliases": aliases}
    new = materialize(new.select("id").distinct().join(old.select(F.col("id").alias("_o")), F.col("id") == F.col("_o"), "left_anti"), "new")
    homes = old.select("id", "cluster", F.lit(None).cast("string").alias("part")) if altered is None else split_altered(signatures, papers, old, altered, eps, linkage, **how)
    homes = materialize(homes.select("id", "cluster", "part", F.to_json(F.struct(F.col("cluster").cast("string").alias("c"), "part")).alias("home")), "homes")
    mine = signatures.join(homes.select("id").unionByName(new).select(F.col("id").alias("_i")), F.col("signature_id") == F.col("_i"), "left_semi")
    distances = materialize(pair_distances(mine, papers, block=block, new=new, **how).select("block", "a", "b", "d"), "incremental")
    rows = signatures.select(F.col(block).alias("block"), F.col("signature_id").alias("id")).join(new, "id", "left_semi")
    if parts is not None:
        rows = rows.join(parts.select("id", F.col("part").alias("_part")), "id").select(F.col("_part").alias("block"), "id")
    place = rows.select(F.col("id").alias("_i"), F.col("block").alias("_k"))
    among = distances.join(place, F.col("a") == F.col("_i")).drop("_i", "block").join(place.toDF("_j", "block"), F.col("b") == F.col("_j")).where(F.col("_k") == F.col("block")).select("block", "a", "b", "d")
    groups = materialize(K.agglomerate(rows.select("block", "id"), among, eps, linkage).select("id", F.col("cluster").alias("grp")), "groups")
    both = distances.select(F.col("a").alias("id"), F.col("b").alias("other"), "d").unionByName(distances.select(F.col("b").alias("id"), F.col("a").alias("other"), "d"))
    across = both.join(new, "id", "left_semi").join(homes.select(F.col("id").alias("other"), F.col("home").alias("cluster")), "other").select("id", "cluster", "d")
    joined = K.assign_incremental(across, groups, eps).select("id", F.col("cluster").alias("home"))
    whole = homes.select("home", "cluster", F.col("part").isNotNull().alias("split")).distinct()
    joined = materialize(joined.join(whole, "home", "left").select("id", "cluster", F.coalesce("split", F.lit(False)).alias("split")), "joined")
    if altered is not None and prevent_new_names:
        first = signatures.select(F.col("signature_id").alias("id"), F.col("first_n").alias("first"))
        names = first.join(homes.select("id", "cluster"), "id").unionByName(first.join(new, "id", "left_semi").withColumn("cluster", F.lit(None).cast(kind)))
        kept = K.name_guard(joined.where("split").select("id", "cluster"), names, aliases)
        joined = joined.where("not split").select("id", "cluster").unionByName(kept)
    joined = materialize(joined.select("id", "cluster"), "kept")
    left = joined.where("cluster is null").select("id")
    again = among.join(left.select(F.col("id").alias("a")), "a", "left_semi").join(left.select(F.col("id").alias("b")), "b", "left_semi").select("block", "a", "b", "d")
    fresh = K.agglomerate(rows.select("block", "id").join(left, "id", "left_semi"), again, eps, linkage).select("id", F.col("cluster").cast(kind).alias("cluster"))
    return homes.select("id", "cluster").unionByName(joined.where("cluster is not null")).unionByName(fresh)


def resolve_incremental(new: DataFrame, old: DataFrame, distances: DataFrame, eps: float = 0.5, linkage: str = "average") -> DataFrame:
    """(id, cluster) of new rows (block, id): the old cluster (id, cluster in `old`) that their group joins, else their own group.

    distances: (block, a, b, d) over new and old rows. New rows are clustered among themselves first."""
    ids = new.select("id")
    among = distances.join(ids.select(F.col("id").alias("a")), "a", "left_semi").join(ids.select(F.col("id").alias("b")), "b", "left_semi").select("block", "a", "b", "d")
    groups = K.agglomerate(new, among, eps, linkage).select("id", F.col("cluster").alias("grp"))
    both = distances.select(F.col("a").alias("id"), F.col("b").alias("other"), "d").unionByName(distances.select(F.col("b").alias("id"), F.col("a").alias("other"), "d"))
    across = both.join(ids, "id", "left_semi").join(old.select(F.col("id").alias("other"), "cluster"), "other").select("id", "cluster", "d")
    joined = K.assign_incremental(across, groups, eps)
    return groups.join(joined, "id").select("id", F.coalesce("cluster", "grp").alias("cluster"))


def evaluate(found: DataFrame, truth: DataFrame) -> DataFrame:
    """B-cubed and pairwise precision, recall and f1 of (id, cluster) against (id, true)."""
    rows = found.join(truth, "id").select(F.col("id").alias("item"), "true", F.col("cluster").alias("pred"))
    b3, pw = M.b_cubed(rows), M.pairwise_prf(rows)
    return b3.select(F.lit("b_cubed").alias("metric"), "*").unionByName(pw.select(F.lit("pairwise").alias("metric"), "*"))


def cached_features(signatures: DataFrame, papers: DataFrame, path: str, version: int = 1, **how) -> DataFrame:
    """Pair features, kept as Parquet by version; pairs that are kept are not computed again (keys are unordered)."""
    from pyspark.errors import AnalysisException

    spark = signatures.sparkSession
    where = f"{path}/version={version}"
    fresh = N.featurize(signatures, papers, **how)
    try:
        kept = spark.read.schema(fresh.schema).parquet(where)
    except AnalysisException:
        kept = None
    if kept is not None:
        fresh = fresh.join(kept.select("a", "b"), ["a", "b"], "left_anti")
    fresh.write.mode("append").parquet(where)
    return spark.read.parquet(where)
