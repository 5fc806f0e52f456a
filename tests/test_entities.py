import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import cluster as K
from millrace.operators import entities as N


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_normalize(spark):
    assert one(spark, T.normalize_text(F.lit("  Ñandú O'Brien-2 Straße "))) == "nandu o brien strasse"
    assert one(spark, T.normalize_text(F.lit("O'Brien"), True)) == "obrien"
    assert one(spark, T.normalize_text(F.lit(None).cast("string"))) == ""


def test_missing_is_null(spark):
    none = F.lit(None).cast("string")
    for f in (T.equal, T.equal_middle, T.equal_initial):
        assert one(spark, f(none, F.lit("a"))) is None and one(spark, f(F.lit(""), F.lit("a"))) is None
    assert one(spark, T.equal(F.lit("-"), F.lit("-"))) is None
    assert one(spark, T.difference(F.lit(None).cast("int"), F.lit(3), 50)) is None
    assert one(spark, T.difference(F.lit(1), F.lit(300), 50)) == 50.0
    empty = F.create_map().cast("map<string,int>")
    assert one(spark, T.counter_jaccard(empty, T.counts(F.array(F.lit("a"))))) is None


def test_multiset_jaccard(spark):
    a, b = T.counts(F.array(*map(F.lit, "aab"))), T.counts(F.array(*map(F.lit, "abbc")))
    assert one(spark, T.counter_jaccard(a, b)) == pytest.approx(2 / 5)
    assert one(spark, T.counter_jaccard(a, b, 2)) == 1.0


def test_name_parts(spark):
    assert one(spark, T.same_prefix_tokens(F.lit("j robert"), F.lit("john r"))) is True
    assert one(spark, T.same_prefix_tokens(F.lit(""), F.lit("x"))) is True
    assert one(spark, T.prefix_distance(F.lit("abcd"), F.lit("abx"))) == pytest.approx(1 / 3)
    assert one(spark, T.compute_block(F.lit("anna maria lee"))) == "a lee"
    assert one(spark, T.orcid(F.array(F.lit("x"), F.lit("https://orcid.org/0000-0001-2345-678x")))) == "000000012345678X"


@settings(max_examples=60, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_lcs_is_the_longest(a, b):
    best = max(len(c) for n in range(len(a) + 1) for c in itertools.combinations(a, n) if _inside(c, b))
    assert T._lcs(a, b) == best


def _inside(c, b):
    it = iter(b)
    return all(x in it for x in c)


def _naive(d, eps):
    groups = [[i] for i in range(len(d))]
    while len(groups) > 1:
        x, i, j = min((np.mean([d[a, b] for a in g for b in h]), i, j) for (i, g), (j, h) in itertools.combinations(enumerate(groups), 2))
        if x > eps:
            break
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10**6), st.floats(0.05, 0.9))
def test_average_linkage(n, seed, eps):
    d = np.random.default_rng(seed).random((n, n))
    d = (d + d.T) / 2
    np.fill_diagonal(d, 0)
    label = K.flat_clusters(d, eps)
    assert {frozenset(np.flatnonzero(label == x).tolist()) for x in set(label.tolist())} == _naive(d, eps)


@pytest.mark.parametrize("linkage", K.LINKAGES)
def test_linkages_give_whole_trees(linkage):
    x = np.random.default_rng(1).random((12, 3))
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert len(K.merge_tree(d, linkage)) == 11


def test_agglomerate_keeps_all_ids(spark):
    rows = spark.createDataFrame([("p", 1), ("p", 2), ("p", 3), ("q", 4)], "block string, id long")
    d = spark.createDataFrame([("p", 1, 2, 0.1)], "block string, a long, b long, d double")
    assert {(r["id"], r["cluster"]) for r in K.agglomerate(rows, d).collect()} == {(1, 1), (2, 1), (3, 3), (4, 4)}


def test_seeds_merge_and_guard(spark):
    clusters = spark.createDataFrame([(i, i // 2) for i in range(8)], "id long, cluster long")
    require = spark.createDataFrame([(0, "s"), (3, "s"), (2, "t"), (7, "t")], "id long, seed string")
    got = {r["id"]: r["cluster"] for r in K.merge_seeded(clusters, require).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 2, 5: 2, 6: 0, 7: 0}
    assigned = spark.createDataFrame([(10, 1), (11, 1)], "id long, cluster long")
    names = spark.createDataFrame([(1, 1, "anna"), (10, None, "ann"), (11, None, "bob")], "id long, cluster long, first string")
    assert {r["id"]: r["cluster"] for r in K.name_guard(assigned, names).collect()} == {10: 1, 11: None}


def test_greedy_merge(spark):
    parts = spark.createDataFrame([("b", x, 3) for x in "pqr"], "block string, part string, n int")
    scores = spark.createDataFrame([("b", "p", "q", 5.0), ("b", "q", "r", 9.0)], "block string, p string, q string, score double")
    assert {r["part"]: r["merged"] for r in K.greedy_merge(parts, scores, 6).collect()} == {"p": "p", "q": "q", "r": "q"}


def test_subblocks_bound(spark):
    rnd = random.Random(2)
    names = [(i, rnd.choice(["a", "ab", "abc", "abd", "b", "same"])) for i in range(200)]
    out = N.subblocks(spark.createDataFrame(names, "id long, name string"), 30).collect()
    assert len(out) == 200
    sizes = {}
    for r in out:
        sizes.setdefault(r["subblock"], []).append(r["id"])
    assert all("#" in k or len(v) <= 30 for k, v in sizes.items())


def test_features(spark):
    """Two authors of two papers, feature by feature."""
    a = lambda *x: [{"position": i, "author_name": n} for i, n in enumerate(x)]
    papers = spark.createDataFrame(
        [(1, "Deep graph study", "text", "J of Graphs", "Graph Conf", 2000, a("Ann Lee", "Bob Ray"), [2]), (2, "Deep graph trees", None, "J of Graphs", None, 1990, a("Ann Lee", "Bob Ray", "Cy Poe"), [])],
        "paper_id long, title string, abstract string, journal_name string, venue string, year int, authors array<struct<position:int,author_name:string>>, references array<long>",
    )
    prepared = N.prepare_papers(papers).select("*", F.lit("en").alias("language"), F.lit(True).alias("reliable"), F.array(F.lit(1.0), F.lit(0.0)).alias("vector"))
    sigs = spark.createDataFrame([("x", 1, "Ann", "M", "Lee", None, 0, "a.lee@u.edu", ["Uni Lab"], []), ("y", 2, "Anne", "", "Lee", None, 0, "a.lee@v.edu", ["Uni Lab"], [])], "signature_id string, paper_id long, first string, middle string, last string, suffix string, position int, email string, affiliations array<string>, source_ids array<string>")
    counts = {k: spark.createDataFrame([("ann", 7), ("lee", 9)], "name string, n int") for k in ("first", "last", "first_last", "last_first_initial")}
    details = N.reference_details(papers)
    prepared = prepared.join(details, "paper_id", "left")
    row = N.featurize(N.prepare_signatures(sigs, prepared, counts), prepared, references=True).first()
    assert (row["a"], row["b"]) == ("x", "y")
    want = {"first_names_equal": 0, "middle_initials_overlap": None, "middle_names_equal": None, "middle_one_missing": 1, "single_char_first": 0, "single_char_middle": 1, "affiliation_overlap": 1, "email_prefix_equal": 1, "email_suffix_equal": 0, "coauthor_overlap": 0.5, "coauthor_match": 0.5, "venue_overlap": None, "year_diff": 10, "references_self_citation": 1, "references_overlap": None, "position_diff": 0, "abstract_count": 1, "english_count": 2, "same_language": 1, "language_reliability_count": 2, "first_name_count_min": 1, "last_name_count_min": 9, "first_name_count_max": 7, "embedding_cosine": 2, "first_name_levenshtein": 0.25, "first_name_prefix": 0}
    assert {k: row[k] for k in want} == want
    assert row["title_overlap_words"] == pytest.approx(3 / 9) and 0.9 < row["first_name_jaro"] < 1
    assert len(N.FEATURES) == 39 and set(N.columns_of(["year_diff", "name_counts"])) < set(N.FEATURES)


def test_constraints(spark):
    cols = "first_n middle_n last_n orcid seed reliable language".split()
    base = dict(first_n="ann", middle_n="", last_n="lee", orcid=None, seed=None, reliable=False, language="en")
    cases = [({}, {}, None), ({}, {"first_n": "bob"}, N.HIGH), ({"orcid": "1"}, {"orcid": "1", "last_n": "x"}, 0.0), ({"seed": 1}, {"seed": 1}, 0.0), ({"seed": 1}, {"seed": 2}, N.DISALLOW), ({"last_n": "ou yang"}, {"last_n": "ouyang"}, None), ({"middle_n": "j"}, {"middle_n": "k"}, N.HIGH), ({"middle_n": "john"}, {"middle_n": "james"}, N.HIGH), ({"middle_n": "de k"}, {"middle_n": "de m"}, N.HIGH), ({"reliable": True}, {"reliable": True, "language": "fr"}, N.HIGH)]
    rows = [tuple(({**base, **x})[c] for c in cols) + tuple(({**base, **y})[c] for c in cols) + (False, i) for i, (x, y, _) in enumerate(cases)]
    kinds = {"seed": "int", "reliable": "boolean"}
    schema = ", ".join(f"{c}_{s} {kinds.get(c, 'string')}" for s in "ab" for c in cols) + ", disallowed boolean, i int"
    got = {r["i"]: r["v"] for r in spark.createDataFrame(rows, schema).select("i", N.constraint(F.lit(False)).alias("v")).collect()}
    assert got == {i: c[2] for i, c in enumerate(cases)}


@pytest.mark.parametrize("tile", [1, 7, 2000])
def test_hot_block_is_paired_whole(spark, tile):
    ids = {"hot": range(40), "two": (50, 60), "one": (70,), None: (80, 81)}
    rows = spark.createDataFrame([(i, k, f"c{i}") for k, v in ids.items() for i in v], "id long, k string, c string")
    got = sorted((r["id_a"], r["id_b"], r["c_a"], r["c_b"], r["k_a"]) for r in N.pairs_in_block(rows, "k", "id", tile).collect())
    assert got == sorted((a, b, f"c{a}", f"c{b}", k) for k, v in ids.items() if k for a, b in itertools.combinations(v, 2))


def test_features_cover_whole_blocks(spark):
    from millrace.plans import entity_queries as Q
    from millrace.plans.fixtures import bibliography

    sf = "/root/testdata/sf0.001"
    sizes = bibliography(spark, sf).groupBy("block").count().collect()
    assert Q.pair_features_39(spark, sf).select("a", "b").distinct().count() == sum(r["count"] * (r["count"] - 1) // 2 for r in sizes) == 364482
