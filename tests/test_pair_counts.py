"""Queries whose pairs are counted and not made, against brute force and SQL on awkward rows."""

import time
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from millrace.functions import lines as L
from millrace.functions import text as T
from millrace.operators import cluster as K
from millrace.operators import entities as N
from millrace.operators import pair_counts as C
from millrace.operators import pair_vectors as V
from millrace.operators import rules as R


def test_incremental_halves_round_as_in_sql(spark):
    # (0.333333333 + 0.3) / 2 is the double below 0.3166666665, which SQL's round takes for the half and rounds up
    rows = [(0, 1, 0.3), (0, 1, 0.3), (0, 1, 0.4), (1, 1, 0.3), (0, 0, 0.316666667), (1, 0, 0.316666667)]
    d = spark.createDataFrame(rows, "id long, cluster long, d double")
    got = {r["id"]: r["cluster"] for r in K.assign_incremental(d, spark.createDataFrame([(0, 0), (1, 0)], "id long, grp long")).collect()}
    con = duckdb.connect()
    con.execute("create table v(id bigint, cluster bigint, d double)")
    con.executemany("insert into v values (?, ?, ?)", rows)
    want = con.execute("WITH p AS (SELECT id, cluster, round(avg(d), 9) AS d FROM v GROUP BY 1, 2), m AS (SELECT cluster, round(avg(d), 9) AS d FROM p GROUP BY 1) SELECT arg_min(cluster, (d, cluster)) FROM m").fetchone()[0]
    assert want == 0 and got == {0: 0, 1: 0}


def test_rounded_is_sql_round(spark):
    xs = [0.31666666649999997, 0.2666666665, -0.2666666665, 0.5, 1e300, -1.0000000005, 0.0, None]
    got = [r["x"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").orderBy("i").select(K.rounded(F.col("x")).alias("x")).collect()]
    assert got == [duckdb.execute("select round(?::double, 9)", [x]).fetchone()[0] for x in xs]


def people(spark, n=400, seed=5):
    """Rows with equal keys, missing values and one large block."""
    import random

    r = random.Random(seed)
    some = lambda *x: r.choice(x)
    rows = [(some("x", "x", "x", "y", None), some(None, i, i, i, i // 2, i // 9) if i % 7 else i // 3, some("ann", "bob", "cy d", None), r.randrange(9), some(1990, 1991, 2003, None), some(1, 2, 3, 70, None)) for i in range(n)]
    df = spark.createDataFrame(rows, "block string, sig long, name string, person int, year int, position int")
    return df.repartition(7), [(p, q) for p in rows for q in rows if p[0] and p[0] == q[0] and p[1] is not None and q[1] is not None and p[1] < q[1]]


def counted(df, *cols):
    return {tuple(r[c] for c in cols): r["n"] for r in df.collect()}


def test_sums_of_first(spark):
    rows, pairs = people(spark)
    want = {}
    for p, _ in pairs:
        n, t = want.get(p[0], (0, 0))
        want[p[0]] = (n + 1, t + p[1] % 1000)
    got = C.sums_of_first(rows.withColumn("v", F.col("sig") % 1000), "block", "sig", "v")
    assert {r["block"]: (r["n"], r["total"]) for r in got.collect()} == want


def test_category_counts(spark):
    rows, pairs = people(spark)
    same = lambda x, y: "same" if x is not None and x == y else "different"
    want = Counter((f"{same(p[2], q[2])}_name_{same(p[3], q[3])}_cluster",) for p, q in pairs)
    assert counted(C.category_counts(rows, "block", "sig", "name", "person"), "category") == want


def test_ordered_pairs(spark):
    rows, pairs = people(spark)
    want = Counter((p[0], p[4], q[4], p[5], q[5], p[2], q[2]) for p, q in pairs)
    got = C.ordered_pairs(rows, "block", "sig", ["year", "position", "name"])
    assert counted(got, "block", "year_a", "year_b", "position_a", "position_b", "name_a", "name_b") == want


def test_pairs_of_one_hot_key(spark):
    rows = spark.createDataFrame([("x", 1, i % 3) for i in range(300)] + [("x", 2, 5)], "block string, sig long, v int")
    assert counted(C.ordered_pairs(rows, "block", "sig", ["v"]), "v_a", "v_b") == {(i, 5): 100 for i in range(3)}


def test_kinds_of_pairs(spark):
    rows, pairs = people(spark)
    want = Counter()
    for p, q in pairs:
        a, b = sorted(((p[2] or "", p[4] or 0), (q[2] or "", q[4] or 0)))
        want[(p[0], (p[1] + q[1]) % 5 == 0, p[3] == q[3], *a, *b)] += 1
    kinds = C.kinds_of_pairs(rows, "block", "sig", ["name", "year"], "person", 5).fillna("").fillna(0)
    got = counted(kinds, "block", "disallowed", "equal", "name_a", "year_a", "name_b", "year_b")
    assert got == want


def test_shared_elements(spark):
    import random

    r = random.Random(3)
    for letters, most in ((6, 17), (90, 17), (8, 3)):
        rows = [(r.choice("xxy"), i if i % 5 else i // 3, r.sample(range(letters), r.randrange(0, 7))) for i in range(150)]
        want = Counter()
        for p in rows:
            for q in rows:
                if p[0] == q[0] and p[1] < q[1] and (n := len(set(p[2]) & set(q[2]))):
                    want[(p[0], *sorted((len(p[2]), len(q[2]))), n)] += 1
        df = spark.createDataFrame(rows, "block string, sig long, co array<int>")
        assert counted(C.shared_elements(df, "block", "sig", "co", most), "block", "size_a", "size_b", "shared") == want


def test_validation_rule_is_linear_in_lines(spark):
    n = 40000
    text = "\n".join(("if x is None:", "", "  raise ValueError(x)" if i % 2 else "  pass")[i % 3] for i in range(n))
    files = L.with_lines(spark.createDataFrame([("f.py", text)], "path string, text string"))
    t = time.time()
    got = R.line_rule(files, next(r for r in R.RULES if r.rule_id == "S1_VALIDATION")).select("start_line", "end_line").collect()
    assert time.time() - t < 20  # each line looked at all lines behind it
    want = [(i + 1, i + 3) for i in range(0, n, 3) if i + 2 < n and (i + 2) % 2][:30]
    assert [tuple(r) for r in got] == want


def test_cosines_in_block(spark):
    import random

    r = random.Random(2)
    vector = lambda i: {0: None, 1: [0.0, 0.0, 0.0], 2: [1.0, None, 0.0], 3: [1.0, 2.0]}.get(i % 23, [r.random() - 0.5 for _ in range(3)])
    rows = [(i % 2 if i % 11 else None, i if i % 6 else i // 2, vector(i)) for i in range(90)]
    df = spark.createDataFrame(rows, "label int, id long, v array<double>")
    pairs = N.pairs_in_block(df, "label", "id").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), F.round(T.cosine(F.col("v_a"), F.col("v_b")) + 1, 6).alias("sim"))
    show = lambda x: sorted((a, b, repr(s)) for a, b, s in x.collect())
    for tile in (2000, 7):
        assert show(V.cosines_in_block(df, "label", "id", "v", tile=tile)) == show(pairs)


def test_average_linkage_of_vectors_is_that_of_their_distances():
    import numpy as np

    r = np.random.default_rng(4)
    for n, d, eps in ((1, 3, 0.5), (2, 3, 0.5), (60, 3, 0.1), (80, 4, 0.5), (120, 8, 0.5), (90, 2, 0.02), (70, 6, 1.2)):
        v = r.normal(size=(n, d))
        v[n // 2 :: 3] = v[: len(v[n // 2 :: 3])]  # copies
        u = v / np.sqrt((v * v).sum(1, keepdims=True))
        u[5:6] = 0
        distance = 1 - u @ u.T
        assert V.average_linkage(u, eps).tolist() == K.flat_clusters(distance, eps).tolist()


def test_average_linkage_holds_no_matrix(spark):
    import numpy as np

    r = np.random.default_rng(1)
    centres = np.eye(40)
    rows = [(0, i, (centres[i % 40] + 0.05 * r.normal(size=40)).tolist()) for i in range(4000)]
    t = time.time()
    got = {x["id"]: x["cluster"] for x in V.agglomerate_vectors(spark.createDataFrame(rows, "label int, id long, v array<double>"), "label", "id", "v").collect()}
    assert got == {i: i % 40 for i in range(4000)}
    assert time.time() - t < 30


def test_gram_scores_are_looked_up(spark, monkeypatch):
    from millrace.plans import entity_queries as Q

    sf = "/root/testdata/sf0.001"
    rows = lambda: sorted((r["a"], r["b"], r["score"]) for r in Q.ngram_multiset_jaccard(spark, sf).collect())
    few = rows()
    plan = Q.ngram_multiset_jaccard(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert len(few) > 0 and "FlatMapGroupsInArrow" in plan  # scores of types, not of pairs
    monkeypatch.setattr(Q, "_FEW_TYPES", 0)
    assert rows() == few


def test_balanced_sample_with_sizes(spark):
    pairs = spark.range(9000).selectExpr("id as a", "id + 1 as b", "case when id % 40 = 0 then 'few' else 'many' end as category")
    want = {tuple(r) for r in N.balanced_sample(pairs, "category", 20, 7, "a", "b").collect()}
    some = N.balanced_sample(pairs, "category", 20, 7, "a", "b", sizes={"few": 225, "many": 8775})
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r) for r in some.collect()} == want and "Range" not in plan
    # told too many, so that too few hashes are small enough
    assert {tuple(r) for r in N.balanced_sample(pairs, "category", 20, 7, "a", "b", sizes={"few": 225, "many": 10**9}).collect()} == want
