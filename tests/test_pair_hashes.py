"""Pairs with small hashes, which are found without rows for the others, against pairs that are made."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import entities as N
from millrace.operators import pair_hashes as H


def test_first_words_are_those_of_md5():
    r = random.Random(1)
    for x in (0, 1, 9, 20, 60, 130):
        for y in (0, 2, 11, 25, 64):
            a, b = ([bytes(r.randrange(33, 127) for _ in range(size)) for _ in range(4)] for size in (x, y))
            got = H._first_word(*H._words(a, b, b"-12_"), 1, 4, 2, np.empty((6, 6), dtype=np.uint32))
            assert got.tolist() == [[int(hashlib.md5(b"-12_" + p + b"_" + q).hexdigest()[:8], 16) for q in b[2:]] for p in a[1:]]


def _rows(spark, kind, n=500):
    """Keys of several lengths and signs, some shared or missing; missing names and clusters; one large block."""
    r = random.Random(2)
    key = lambda i: r.choice([i - 250, 10 ** r.randrange(16) + i, i // 3])
    text = lambda i: r.choice(["é", "key_of_many_letters" * 4, ""]) + str(key(i))
    rows = [(r.choice(["x", "x", "x", "y", None]), None if i % 50 == 1 else key(i) if kind == "long" else text(i), r.choice(["ann", "bob", "cy d", None]), r.choice([*range(40), None])) for i in range(n)]
    return spark.createDataFrame(rows, f"block string, id {kind}, name string, person int").localCheckpoint()


@pytest.mark.parametrize("tile, batch, few", [(5000, 1 << 15, 1000), (60, 700, 0), (5000, 300, 0)])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_all_pairs_with_small_hashes_are_found(spark, monkeypatch, kind, tile, batch, few):
    monkeypatch.setattr(H, "BATCH", batch)
    monkeypatch.setattr(H, "FEW", few)
    rows = _rows(spark, kind)
    category = N.pair_category(F.col("name_a"), F.col("name_b"), F.col("person_a"), F.col("person_b"))
    pairs = N.pairs_in_block(rows, "block", "id").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), category.alias("category"))
    share = {"different_name_different_cluster": 0.003, "different_name_same_cluster": 0.2, "same_name_different_cluster": 0.05}
    bound = F.coalesce(*(F.when(F.col("category") == c, format(int(x * 2**64), "016x")) for c, x in share.items()), F.lit("g"))
    small = lambda df: sorted(map(tuple, df.where(N.hash_order(7, "a", "b") < bound).collect()))
    # in the workers the constants are those of the module, so tiles are also run here
    got = H.small_pairs(rows, "block", "id", "name", "person", 7, share, tile)
    want = small(pairs)
    assert small(got) == want and len(want) > 500
    names = {"_block": "block", "_key": "id", "_name": "name", "_cluster": "person"}
    data = rows.where("block = 'x' and id is not null").select(*(F.col(c).alias(n) for n, c in names.items()), F.col("id").cast("string").alias("_text"), (F.xxhash64("id") % 2 != 0).cast("int").alias("_part")).toArrow()
    most = np.array([int(share.get(c, 1) * 2**32 - 1) for c in H.CATEGORIES], dtype=np.uint32)
    tiles = []
    for p, q in ((0, 0), (0, 1), (1, 1)):
        part = data.filter([x in (p, q) for x in data["_part"].to_pylist()])
        part = part.append_column("_p", [[p] * len(part)]).append_column("_q", [[q] * len(part)])
        tiles += [tuple(r.values()) for b in H._tile(part, b"7_", most) for r in b.to_pylist()]
    of = spark.createDataFrame(tiles, f"a {kind}, b {kind}, category string")
    assert small(of) == small(N.pairs_in_block(rows.where("block = 'x'"), "block", "id").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), category.alias("category")))
    if few == 0:
        assert len(tiles) < 0.5 * pairs.count()


def test_balanced_sample_makes_no_pairs(spark, monkeypatch):
    """Before, all pairs were joined and hashed as rows, which sf0.1 did not end in time."""
    rows = spark.range(1500).selectExpr("if(id % 3 = 0, 'x', 'y') as block", "id * 77777 as sig", "concat('n', id % 11) as name", "if(id % 500 = 0, 0, id) as person")
    category = N.pair_category(F.col("name_a"), F.col("name_b"), F.col("person_a"), F.col("person_b"))
    pairs = N.pairs_in_block(rows, "block", "sig").select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b"), category.alias("category"))
    want = {tuple(r) for r in N.balanced_sample(pairs, "category", 100, 7, "a", "b").collect()}
    monkeypatch.setattr(N, "pairs_in_block", lambda *x: spark.createDataFrame([], "sig_a long, sig_b long, name_a string, name_b string, person_a long, person_b long"))
    assert {tuple(r) for r in N.balanced_pairs(rows, "block", "sig", "name", "person", 100, 7).collect()} == want
