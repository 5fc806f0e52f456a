"""Name order, language and the fitted pairwise model."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import language
from millrace.operators import entities as N
from millrace.operators import name_order as O
from millrace.operators import pairwise_model as P

SIG = "signature_id string, paper_id long, position int, first string, middle string, last string, block string"
PARSE = O.PARSE.format(key="long")


def signed(spark, rows):
    return spark.createDataFrame([(f"s{i}", p, q, f, "", last, "x") for i, (p, q, f, last) in enumerate(rows)], SIG)


def parsed(spark, rows):
    return spark.createDataFrame([(p, q, g.split("-"), s.split("-"), None, []) for p, q, g, s in rows], PARSE)


@pytest.mark.parametrize("turned,straight,single,want", [(3, 1, 0, True), (2, 3, 0, False), (2, 0, 0, True), (0, 0, 1, True), (0, 0, 0, False), (1, 1, 5, False)])
def test_gate(spark, turned, straight, single, want):
    """Papers with several authors decide by the ratio; single ones only where there are no others."""
    sigs, told = [], []
    for i in range(turned + straight):
        sigs += [(i, 0, "Ping", "Zhang"), (i, 1, "Co", f"Author{i}")]
        told += [(i, 0, "Zhang", "Ping") if i < turned else (i, 0, "Ping", "Zhang")]
    for i in range(50, 50 + single):
        sigs.append((i, 0, "Ping", "Zhang"))
        told.append((i, 0, "zhang", "ping"))
    sigs.append((99, 0, "Ping", "Zhang"))  # without a parse: still allowed if the name is
    allow = {(r["paper_id"], r["position"]) for r in O.overwrite_gate(signed(spark, sigs), parsed(spark, told) if told else spark.createDataFrame([], PARSE)).collect()}
    places = {(p, q) for p, q, f, _ in sigs if f == "Ping"}
    assert allow == (places if want else set())


def test_overwrites(spark):
    sigs = signed(spark, [(1, 0, "Ou Yang", "Xiao Ming"), (1, 1, "Ann", "Lee"), (2, 0, "Li", "Wei")])
    told = spark.createDataFrame([(1, 0, ["Xiao", "Ming"], ["Ou", "Yang"], " Ou-Yang ", ["J", ""]), (2, 0, ["Wei"], ["Li"], None, []), (2, 1, ["No"], ["One"], None, [])], PARSE)
    rows = {r["signature_id"]: (r["first"], r["middle"], r["last"], r["block"], r["overwritten"]) for r in O.overwrite_signatures(sigs, told, blocks=True).collect()}
    assert rows == {"s0": ("Xiao-Ming", "J", "Ou-Yang", "x ouyang", True), "s1": ("Ann", "", "Lee", "x", False), "s2": ("Wei", "", "Li", "w li", True)}
    allow = spark.createDataFrame([(2, 0)], "paper_id long, position int")
    assert [r["first"] for r in O.overwrite_signatures(sigs, told, allow).orderBy("signature_id").collect()] == ["Ou Yang", "Ann", "Wei"]
    papers = spark.createDataFrame([(1, "t", [(0, "Ou Yang Xiao Ming"), (1, "Ann Lee")]), (2, "u", [(0, "Wei Li")]), (3, "v", None)], "paper_id long, title string, authors array<struct<position:int,author_name:string>>")
    out = {r["paper_id"]: r for r in O.overwrite_papers(papers, told).collect()}
    assert [a["author_name"] for a in out[1]["authors"]] == ["Xiao-Ming J Ou-Yang", "Ann Lee"] and out[1]["n_overwritten"] == 1
    assert out[2]["n_overwritten"] == 0 and out[3]["authors"] is None


def test_parsing_by_paper(spark):
    """One unknown name on a paper keeps the order of the others."""

    def parser(names):
        return [None if "Smith" in n else {"parsed": {"given_tokens": n.split()[1:], "surname_tokens": n.split()[:1]}, "original_order": {"given_tokens": n.split()[:1], "surname_tokens": n.split()[1:]}} for n in names]

    papers = spark.createDataFrame([(1, [(0, "Li Wei"), (1, None)]), (2, [(0, "Li Wei"), (1, "Jo Smith")]), (3, []), (4, None)], "paper_id long, authors array<struct<position:int,author_name:string>>")
    assert {(r["paper_id"], r["position"], *r["given_tokens"], *r["surname_tokens"]) for r in O.parse_names(papers, parser).collect()} == {(1, 0, "Wei", "Li"), (2, 0, "Li", "Wei")}


def test_language_of_two_detectors(spark):
    seen = []
    one = lambda t: seen.append(t) or ("de" if "der" in t else "en" if "the" in t else None)

    def two(t):
        if "!" in t:
            raise ValueError
        return "en" if "the" in t.lower() else "un"

    assert language.detect("the cat", one, two) == (True, True, "en") and language.detect("der hund", one, two) == (True, False, "de")
    assert language.detect("der the", one, two) == (False, False, "un") and language.detect("THE CAT\nSAT!", one, two) == (True, True, "en") and seen[-1] == "the cat sat!"
    assert language.detect("word", one, two) == language.detect(None, one, two) == language.detect("1 2", one, two) == language.detect("qu est", one, two) == (False, False, "un")
    rows = spark.createDataFrame([("the cat",), (None,)], "t string").select(language.language_of(F.col("t"), lambda t: "en").alias("x")).select("x.*").collect()
    assert [tuple(r) for r in rows] == [(True, True, "en"), (False, False, "un")]


def test_model_is_monotone_and_searched(spark):
    rnd = random.Random(1)
    rows = []
    for _ in range(600):
        y = rnd.random() < 0.5
        # b speaks against its sign, c is often missing
        rows.append((int(y), y + rnd.gauss(0, 0.7), y + rnd.gauss(0, 0.7), (y + rnd.gauss(0, 0.5)) if rnd.random() < 0.6 else None, rnd.random()))
    df = spark.createDataFrame(rows, "label int, a double, b double, c double, noise double")
    model = P.fit(df.limit(400), ["a", "b", "c", "noise"], signs={"a": 1, "b": -1}, val=df)
    assert model.weights["a"][1] > 0.5 and model.weights["b"][1] <= 1e-9 and model.penalty in P.PENALTIES and model.auroc > 0.85
    scored = df.select("*", model.probability().alias("p"), (model.distance() + model.probability()).alias("one"))
    assert scored.where("p < 0 or p > 1 or abs(one - 1) > 1e-9 or p is null").count() == 0
    shares = P.feature_shares(df.withColumn("k", F.monotonically_increasing_id()), model, ["k"]).groupBy("k").agg(F.sum("share").alias("s"))
    total = df.withColumn("k", F.monotonically_increasing_id()).select("k", model.probability().alias("p")).join(shares, "k")
    assert total.where(F.abs(1 / (1 + F.exp(-(F.col("s") + model.bias))) - F.col("p")) > 1e-9).count() == 0
    assert P.fit(df, ["a"]).auroc is None and sorted(P.signs_of(["year_diff", "email_similarity"]).items()) == [("email_prefix_equal", 1), ("email_suffix_equal", 1), ("year_diff", -1)]
    assert list(P.signs_of()) == N.FEATURES
