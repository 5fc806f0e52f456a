"""Operators with exact results against brute force or SQL, with awkward inputs."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import same, views
from millrace.llm import ann_dedup, common, decontaminate, line_dedup, ngram_join, packing, pii, registry, suffix_dedup, token_shards

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, con, name):
    same(registry.QUERIES[name](spark, SF), con, registry.SQL[name])


def docs(spark, texts, **extra):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# ---------------------------------------------------------------- components
@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 5), (7, 3), (3, 9), (20, 21)]])
def test_components(spark, edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r["node"]: r["comp"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


# ---------------------------------------------------------------- n-gram join
def _sets(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def _classes(texts):
    sets = [_sets(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("rare_df", [0, 2, 32])
def test_jaccard_join_is_exact(spark, rare_df):
    rnd = random.Random(rare_df)
    word = lambda n: [f"w{rnd.randint(0, n)}" for _ in range(rnd.randint(0, 70))]
    base = [word(400) for _ in range(6)] + [["x"] * 60]
    texts = [None, "", " \t\n", "One two", "one TWO", "ÀB c", "àB c"]
    for _ in range(140):
        w = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 5)):
            if w:
                w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 9)}"
        texts.append(rnd.choice([" ", "\n", "  "]).join(w))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(docs(spark, texts), rare_df=rare_df).collect()}
    assert got == _classes(texts)


def test_prefix_share_guarantee():
    """Sets at the threshold always share an index key, whatever the classes."""
    rnd = np.random.default_rng(4)
    for _ in range(400):
        n = int(rnd.integers(1, 90))
        x = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        keep = x[rnd.random(len(x)) < 0.9]
        y = np.unique(np.concatenate([keep, rnd.integers(0, 2**63, int(rnd.integers(0, 12)), dtype=np.uint64)]))
        inter = len(np.intersect1d(x, y))
        if inter < 0.75 * (len(x) + len(y) - inter) or not inter:
            continue
        cut = np.uint64(rnd.integers(0, 2**63))
        shared = set(np.intersect1d(x, y).tolist())

        def sig(v):
            cls = np.array([1 + (h < cut) if int(h) in shared else 0 for h in v], np.uint8)
            return set(ngram_join.signatures(v, cls).tolist())

        assert sig(x) & sig(y)


def test_extra_columns_and_repeats(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "A b c d e f", "y"), (None, "z", None), (3, None, None)], "doc_id long, text string, node string")
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in ngram_join.drop_near_copies(df).select("doc_id").collect()) == [(False, 1), (False, 3), (True, None)]
    assert ngram_join.drop_near_copies(df).columns == df.columns
    assert ngram_join.jaccard_components(df.limit(0)).count() == 0


def test_one_id_with_different_texts(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    df = spark.createDataFrame([(1, one, "x"), (1, two, "x"), (1, two, "x"), (2, two + " c", "y"), (3, one, "z"), (4, "", "z"), (4, None, "z"), (5, one + " d", "z"), (None, one, "n")], "doc_id long, text string, node string")
    out = ngram_join.drop_near_copies(df)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == [(0, one), (1, one), (1, two), (4, ""), (4, "")]
    assert out.columns == df.columns


# ---------------------------------------------------------------- suffixes
def _cut(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = defaultdict(list)
    for i, r in enumerate(raws):
        for j in range(len(r) - length + 1):
            seen[r[j : j + length]].append((i, j))
    gone = [bytearray(len(r)) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for i, j in places:
                gone[i][j : j + length] = b"\1" * length
    out = {}
    for i, (r, g) in enumerate(zip(raws, gone)):
        kept = bytes(b for b, x in zip(r, g) if not x)
        out[i] = (len(r), sum(g), sum(1 for j in range(len(g)) if g[j] and not (j and g[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("length,gram,bucket", [(20, 8, 20000), (20, 8, 3), (13, 4, 20000), (13, 4, 10), (6, 6, 5)])
def test_suffix_dedup_is_exact(spark, length, gram, bucket):
    """Small buckets part the runs."""
    rnd = random.Random(length + bucket)
    base = ["".join(rnd.choice("ab é") for _ in range(rnd.randint(0, 90))) for _ in range(10)]
    texts = [None, "", "a" * 200, "ab" * 60, "x\0\0\0" * 9 + "y", "x\0\0\0" * 8] + ["".join(rnd.choice(base)[rnd.randint(0, 20) : rnd.randint(30, 90)] for _ in range(rnd.randint(0, 4))) for _ in range(60)]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(docs(spark, texts), length=length, gram=gram, bucket=bucket).collect()}
    assert got == _cut(texts, length)


def test_suffix_dedup_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x" * 3 + "abcdefghij" * 3), (1, "x" * 3 + "abcdefghij" * 3)], "doc_id long, text string")
    rows = suffix_dedup.suffix_dedup(df, length=20, gram=8, with_text=True).collect()
    assert len(rows) == 2 and all(r["n_removed"] == 33 and bytes(r["kept"]) == b"" for r in rows)
    assert suffix_dedup.suffix_dedup(df.limit(0)).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=3, max_size=3), min_size=1, max_size=40))
def test_multikey_sort(rows):
    t = np.array(rows, np.uint64)
    assert t[suffix_dedup.multikey_sort(t)].tolist() == sorted(rows)


# ---------------------------------------------------------------- lines
def _lines(texts, t):
    seqs = [(i, [(n, x) for n, x in enumerate(s.split("\n")) if x.strip(" ")]) for i, s in enumerate(texts) if s is not None]
    first, gone = {}, defaultdict(set)
    for i, s in seqs:
        for k in range(len(s) - t + 1):
            first.setdefault(tuple(x for _, x in s[k : k + t]), (i, k))
    for i, s in seqs:
        for k in range(len(s) - t + 1):
            if first[tuple(x for _, x in s[k : k + t])] != (i, k):
                gone[i] |= {n for n, _ in s[k : k + t]}
    return {i: None if s is None else "\n".join(x for n, x in enumerate(s.split("\n")) if n not in gone[i]) for i, s in enumerate(texts)}


@pytest.mark.parametrize("k,w", [(1, 1), (1, 2), (2, 2), (2, 3)])
def test_line_dedup_is_exact(spark, k, w):
    rnd = random.Random(k * 10 + w)
    texts = [None, "", "a", "a\na\na\na", "\n\n"] + ["\n".join(rnd.choice(["a", "b", "c", " ", "", "long line"]) for _ in range(rnd.randint(0, 12))) for _ in range(40)]
    df = docs(spark, texts).withColumn("gone", F.lit("keep")).withColumn("fp", F.lit(1))
    out = line_dedup.line_dedup(df, k=k, w=w)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == _lines(texts, k + w - 1)
    assert out.columns[:4] == df.columns


def test_long_single_lines_are_runs(spark):
    long, other, edge = "passage " * 15, "another passage " * 8, "x" * 99
    texts = [f"a\n{long}\nb", f"c\n{long}\nd", long, f"{other}\nshort\n\n{other}", other, f"{edge}\np", f"{edge}\nq", f"{edge}é", f"{edge}é", "short", "short", ""]
    want = [texts[0], "c\nd", "", f"{other}\nshort\n", "", *texts[5:8], "", "short", "short", ""]
    rows = {r["doc_id"]: r for r in line_dedup.line_dedup(docs(spark, texts)).collect()}
    assert [rows[i]["text"] for i in range(len(texts))] == want
    assert [rows[i]["_mr_gone"] for i in range(len(texts))] == [0, 1, 1, 1, 1, 0, 0, 0, 1, 0, 0, 0]
    assert {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs(spark, texts), alone=None).collect()} == _lines(texts, 2)


def test_line_dedup_column_names_and_long_texts(spark):
    texts = ["a\nb\nc", "x\na\nb", None, "\n".join(f"line {i}" for i in range(50_000)), "\n".join(f"line {i}" for i in range(49_990, 50_003))]
    df = spark.createDataFrame([(i, t, 1, "g", "h", 2.0, 3) for i, t in enumerate(texts)], "doc_id long, text string, _mr_fp int, _mr_gone string, _mr_d string, _mr_cut double, `x.y` int")
    rows = {r["doc_id"]: r for r in line_dedup.line_dedup(df).collect()}
    n_lines, n_gone = line_dedup.count_names(df.columns)
    assert n_gone == "__mr_gone" and all(r["_mr_gone"] == "g" and r["_mr_fp"] == 1 and r["x.y"] == 3 for r in rows.values())
    assert [rows[i][n_gone] for i in range(5)] == [0, 2, 0, 0, 10] and rows[4]["text"] == "line 50000\nline 50001\nline 50002" and rows[3][n_lines] == 50_000
    again = line_dedup.line_dedup(line_dedup.line_dedup(df))  # its own output is an input too
    assert again.count() == 5 and line_dedup.line_dedup(df.limit(0)).count() == 0


# ---------------------------------------------------------------- packing
def best_fit(lengths, sizes):
    """Best fit decreasing piece by piece: what each bin holds, before downsizing."""
    todo = Counter(lengths)
    bins = []
    for length in sorted(todo, reverse=True):
        for left in range(todo[length], 0, -1):
            fits = [b for b in bins if b[0] >= length]
            if not fits:
                cap = packing.size_to_open(length, left, sizes)
                fits = [[cap, cap] for _ in range(-(-left // (cap // length)))]
                bins += fits
            min(fits)[0] -= length
    return sorted(cap - room for room, cap in bins if room < cap)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=50), st.sampled_from([(32,), (8, 32), (4, 8, 16, 32)]))
def test_plan_is_valid_and_best_fit(lengths, sizes):
    runs, ranges = packing.pack(dict(Counter(lengths)), sizes)
    assert sum(r[2] for r in runs) == len(lengths) and sum(b * f for _, b, f in ranges) == sum(lengths)
    bins = defaultdict(list)
    for n, _, count, first, m, offset in runs:
        for i in range(count):
            bins[first + i // m].append((offset + (i % m) * n, n))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x + y == z for (x, y), (z, _) in zip(b, b[1:])) and sum(n for _, n in b) <= max(sizes)
    assert sorted(f for _, n, f in ranges for _ in range(n)) == best_fit(lengths, sizes)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=30), st.sampled_from([(16,), (4, 16), (4, 8, 16), (3, 5, 11, 16)]))
def test_sizes_are_chosen_jointly(lengths, sizes):
    """The plan costs what the cheapest set of opening sizes costs when packed piece by piece and downsized."""
    every = [(*some, sizes[-1]) for n in range(len(sizes)) for some in combinations(sizes[:-1], n)]
    want = min(sum(packing.cost(min(c for c in sizes if c >= f), sizes[-1]) for f in best_fit(lengths, s)) for s in every)
    assert abs(packing.best_plan(dict(Counter(lengths)), sizes)[0] - want) < 1e-9


def test_packing_query_counts_token_ids(spark):
    docs_ = spark.read.parquet(f"{SF}/documents.parquet")
    enc = token_shards.encoder(open(token_shards.VOCABULARY, "rb").read())
    want = sum(len(enc.encode_ordinary(r["text"])) + 1 for r in docs_.collect() if r["text"])
    rows = packing.op2_best_fit_packing(spark, SF).collect()
    assert sum(r["n_tokens"] for r in rows) == want and all(0 < r["n_tokens"] <= r["capacity"] - r["offset"] for r in rows)
    odd = spark.createDataFrame([(1, None, 3), (None, "", 4), (1, "a b", 5)], "doc_id long, text string, n_tokens int")
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in token_shards.token_lengths(odd).collect()) == [(0, 0), (1, 0), (1, 3)]


def test_packing_places_every_piece(spark):
    rnd = random.Random(6)
    texts = [None, "", "x" * 70000] + ["y" * rnd.choice([1, 5, 5, 5, 600, 3000]) for _ in range(3000)]
    rows = packing.best_fit_packing(docs(spark, texts), rows_per_bucket=100).collect()
    assert sum(r["n_tokens"] for r in rows) == sum(len(t or "") for t in texts)
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append((r["offset"], r["n_tokens"], r["capacity"]))
    assert sorted(bins) == list(range(len(bins)))
    for b in bins.values():
        b.sort()
        assert b[0][0] == 0 and all(x + n == y for (x, n, _), (y, _, _) in zip(b, b[1:])) and b[-1][2] == packing.downsize(b[-1][0] + b[-1][1], packing.SIZES)
    assert packing.best_fit_packing(docs(spark, [None, ""])).count() == 0


# ---------------------------------------------------------------- decontamination
def _align(a, b):
    best = 0
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=9), st.lists(st.integers(1, 4), min_size=1, max_size=14))
def test_smith_waterman(a, b):
    score, _ = decontaminate.smith_waterman(np.array(a, np.uint64), np.array([b], np.uint64))
    assert score[0] == _align(a, b)


def test_edited_copies_are_found(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    items = [[word() for _ in range(30)] for _ in range(8)]
    texts, want = [], set()
    for i in range(60):
        body = [word() for _ in range(rnd.randint(0, 120))]
        if i % 3 == 0:
            k = rnd.randrange(8)
            copy = list(items[k])
            for _ in range(4):
                copy[rnd.randrange(30)] = word()
            body[5:5] = copy
            want.add((i, k))
        texts.append(" ".join(body).upper() if i % 2 else " ".join(body))
    df = docs(spark, [*texts, None, ""])
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)] + [(90, None), (91, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()} == want
    assert {r["doc_id"] for r in decontaminate.decontaminate(df, bench).collect()} == {i for i in range(62)} - {i for i, _ in want}
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0 and decontaminate.contaminated(df.limit(0), bench).count() == 0


@pytest.mark.parametrize("copies", [1, 300])
def test_one_edited_copy_in_many_documents(spark, copies):
    """The edit breaks a quarter of the item's grams and more; the others are as frequent as the copy."""
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8)))
    item = [word() for _ in range(40)]
    edited = [word() + "x" if i in (5, 14, 23, 32) else w for i, w in enumerate(item)]
    texts = [" ".join([word() for _ in range(20)] + edited + [word() for _ in range(20)]) for _ in range(copies)] + [" ".join(word() for _ in range(80)) for _ in range(100)] + [" ".join(item)]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["score"] for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    assert set(got) == {*range(copies), len(texts) - 1}
    assert {round(v, 6) for i, v in got.items() if i < copies} == {round(_align(item, edited) / 80, 6)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=3, max_size=8), st.lists(st.sampled_from("abcde"), min_size=1, max_size=20))
def test_shared_grams_are_aligned(item, text):
    items = decontaminate.Items([5], [" ".join(item)], 3)
    lo, hi = np.searchsorted(items.g, items.keys), np.searchsorted(items.g, items.keys, "right")
    rows = decontaminate._aligned(items, lo, hi, pa.array([" ".join(text)]), 0.5)
    for r in rows:
        assert r[2] <= _align(item, text) / (2 * len(item))
    half = len(item) // 2 + 1
    # windows of the item's first gram, whatever else the text holds
    heads = [i for i in range(len(text) - 2) if text[i : i + 3] == item[:3]]
    if any(_align(item, text[max(0, i - half) : i + len(item) + half]) >= len(item) for i in heads):
        assert rows


# ---------------------------------------------------------------- embeddings
def _links(x, threshold=0.95):
    """Rows (place, number of links, smallest place reachable) by brute force."""
    good = [i for i, v in enumerate(x) if v and all(e is not None and e == e and abs(e) != float("inf") for e in v) and any(v)]
    u = ann_dedup.unit([x[i] for i in good])
    close = (u @ u.T >= threshold) & ~np.eye(len(u), dtype=bool)
    root = list(range(len(x)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in zip(*np.nonzero(close)):
        a, b = sorted((find(good[a]), find(good[b])))
        root[b] = a
    links = dict(zip(good, close.sum(1).tolist()))
    return {i: (links.get(i, 0), find(i)) for i in range(len(x))}


def test_embedding_links(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 16))
    x = [list(map(float, base[i % 12] + 0.12 * rng.normal(size=16))) for i in range(300)]
    x += [x[0], x[0], None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1e-300] * 16, [1e300] * 16]
    df = spark.createDataFrame([(i, v, "n", 7) for i, v in enumerate(x)], "vec_id long, embedding array<double>, comp string, id int")
    rows = ann_dedup.near_dedup(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows} == {i: (n, c, c == i) for i, (n, c) in _links(x).items()}
    assert all(r["recall"] == 1.0 for r in rows)
    assert ann_dedup.near_dedup(df.limit(0)).count() == 0


def planted(seed, groups, alone, n=64):
    """Groups of near copies of several sizes and radii among vectors of their own."""
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=n) for _ in range(alone)]
    for size, spread in groups:
        c = rng.normal(size=n)
        x += [c + spread * rng.normal(size=n) for _ in range(size)]
    return [list(map(float, x[i])) for i in rng.permutation(len(x))]


@pytest.mark.parametrize("shard", [150, 600])
def test_links_across_shards(spark, monkeypatch, shard):
    """Many shards: no link lost, none counted twice, and the audit agrees."""
    monkeypatch.setattr(ann_dedup, "SHARD", shard)
    x = planted(4, [(2, 0.1)] * 60 + [(5, 0.15)] * 40 + [(80, 0.1), (150, 0.14), (40, 0.2)], 1100)
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    rows = ann_dedup.near_dedup(df).collect()
    got, want = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}, _links(x)
    true, found = sum(n for n, _ in want.values()), sum(n for n, _ in got.values())
    assert true > 20_000 and all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.99 * true and all(r["recall"] >= ann_dedup.RECALL for r in rows)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.99 * len(want)


def test_repeated_and_null_vector_ids(spark):
    e0, e1, near = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.05, 1.0, 0.0]
    df = spark.createDataFrame([(1, e0), (1, e1), (2, e0), (3, near), (None, e0), (None, [0.0, 0.0, 5.0]), (4, [0.0, 0.01, 5.0]), (None, None)], "vec_id long, embedding array<double>")
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in ann_dedup.near_dedup(df).collect()))
    assert got == sorted([(1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False), (0, 2, 1, False), (0, 1, 4, False), (4, 1, 4, True), (0, 0, 0, False)])


def test_blocks_of_a_crowded_shard(spark, monkeypatch):
    monkeypatch.setattr(ann_dedup, "SPLIT", 40)
    rng = np.random.default_rng(3)
    x = [list(map(float, np.eye(8)[0] + 0.05 * rng.normal(size=8))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ann_dedup.near_dedup(df).collect()} == _links(x)


def test_low_recall_widens_the_overlap(spark, monkeypatch):
    monkeypatch.setattr(ann_dedup, "SHARD", 60)
    monkeypatch.setattr(ann_dedup, "SIGMAS", 0.01)
    x = planted(9, [(60, 0.2)] * 6, 400)
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    rows = ann_dedup.near_dedup(df).collect()
    assert rows[0]["recall"] >= ann_dedup.RECALL and sum(r["n_links"] for r in rows) >= ann_dedup.RECALL * sum(n for n, _ in _links(x).values())


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 120), st.integers(1, 6))
def test_graph_holds_every_vector(seed, n, dims):
    """From the medoid's list on, every vector is reached; pruned lists keep their bound."""
    x = ann_dedup.unit(np.random.default_rng(seed).normal(size=(n, dims)))
    first, ends = ann_dedup.lists_of(*ann_dedup.build(x), n)
    reached, todo = {0}, [0]
    while todo:
        for j in _ends(first, ends, todo.pop()):
            if j not in reached:
                reached.add(j)
                todo.append(j)
    assert len(reached) == n


def _ends(first, ends, i):
    return ends[first[i] : first[i + 1]].tolist()


# ---------------------------------------------------------------- personal data
_KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def _base(t):
    out = []
    for n, (kind, p) in enumerate(_KINDS):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "phone" and not 9 <= len(d) <= 15 or kind == "card" and not (12 <= len(d) <= 19 and luhn):
                continue
            out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def test_base_spans(spark):
    rnd = random.Random(5)
    parts = ["a@b.co", "x@y.z_q@r.st", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (23) 456-78 90", "+12", "é", "😀", " ", "word", "@", "+", "0001.02.3.255"]
    texts = [None, "", "1 " * 6000, "a" * 50000, "+" * 200 + "1-" * 3000] + ["".join(rnd.choice(parts) + rnd.choice(["", " ", ", "]) for _ in range(rnd.randint(0, 14))) for _ in range(150)]
    rows = {r["doc_id"]: r for r in pii.sanitise(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want, r = _base(t), rows[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[3] == k for w in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in want).encode()).hexdigest()


def _masked(t):
    out = list(t or "")
    for s, _, e, _ in _base(t):
        out[s:e] = " " * (e - s)
    return "".join(out)


def _word_spans(t):
    return [(m.start(), m.end(), m.group()) for m in regex.finditer(r"\p{L}+", _masked(t))]


def _spans(texts):
    """All spans of each text, and how its terms are treated, by brute force."""
    held = [{f"{n}:{t[s:e].lower() if n == 0 else t[s:e] if n == 1 else re.sub('[^0-9]', '', t[s:e])}" for s, n, e, _ in _base(t)} for t in texts]
    words = [{w.lower() for _, _, w in _word_spans(t)} for t in texts]
    terms = [{w.lower() for _, _, w in _word_spans(t) if regex.match(pii.TERM, w)} for t in texts]
    n_e, n_t = Counter(e for x in held for e in x), Counter(w for x in words for w in x)
    n_te = Counter((t, e) for x, y in zip(held, terms) for e in x for t in y)
    told = {}
    for (t, e), c in n_te.items():
        if n_e[e] < len(texts):
            told[t] = max(told.get(t, -9), math.log2((c - pii.DISCOUNT) * len(texts) / (n_t[t] * n_e[e])) / math.log2(len(texts) / n_e[e]))
    out = []
    for t in texts:
        mine = [(s, 4 + (told[w.lower()] >= pii.REMOVE), e, "remove" if told[w.lower()] >= pii.REMOVE else "generalise") for s, e, w in _word_spans(t) if told.get(w.lower(), -9) >= pii.GENERALISE]
        out.append(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted([*_base(t), *mine])))
    return out


@pytest.mark.parametrize("most", [pii.FREQUENT, 40, 3])
def test_added_spans_are_exact(spark, most):
    """Lists of frequent words and entities that hold all, some and next to none."""
    rnd = random.Random(most)
    names, common = ["Wilhelmina", "Li", "Ottokar", "Ébène", "李雷", "somebody"], ["the", "note", "says", "About", "many", "things", "x"]
    mails = ["w@mail.com", "O@mail.com", "l@x.org", "10.0.0.1", "+49 30 1234567", "4111 1111 1111 1111"]
    texts = [None, "", "Wilhelmina"]
    for i in range(400):
        k = rnd.randrange(6)
        parts = rnd.choices(common, k=rnd.randint(0, 8))
        if rnd.random() < 0.5:
            parts += [names[k] if rnd.random() < 0.8 else rnd.choice(names)] * rnd.randint(0, 2) + [mails[k]] * (rnd.random() < 0.6 or k == 2)
        if rnd.random() < 0.1:
            parts.append(f"Rare{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}")
        rnd.shuffle(parts)
        texts.append(rnd.choice([" ", ", ", "\n"]).join(parts))
    texts += ["Hotword only@one.com"] * 150 + texts[5:9]
    got = {r["doc_id"]: r["spans"] for r in pii.sanitise(docs(spark, [t or "" for t in texts]), with_text=False, most=most).collect()}
    want = _spans([t or "" for t in texts])
    assert [got[i] for i in range(len(texts))] == want
    assert sum("remove" in w for w in want) >= 150 and any("generalise" in w for w in want)


def test_sanitised_texts(spark):
    far = " and so on and so forth, as everybody here has known for many a year;" * 3
    texts = [f"Wilhelmina Li lives here.{far} Reach her at w@mail.com"] * 20 + ["A letter from Wilhelmina arrived", "LI was there", "light and mail"] + [f"note {i}:{far} mail" for i in range(900)]
    texts += ["Ottokar o@mail.com", "Ottmar, c/o 1.2.3.4.5.6.7.8 or +1.2.3.4.56789 (1.2.3.4)", None]
    rows = {r["doc_id"]: r for r in pii.sanitise(docs(spark, texts)).collect()}
    assert "remove:0:10" in rows[0]["spans"] and "remove:11:13" in rows[0]["spans"] and rows[0]["sanitised"].endswith("[EMAIL]")
    assert rows[20]["spans"] == "remove:14:24" and "Wilhelmina" not in rows[20]["sanitised"]
    assert rows[21]["n_terms"] == 1 and rows[21]["sanitised"] == " was there"
    assert all(rows[i]["n_terms"] == 0 and rows[i]["sanitised"] is None for i in (22, 23, 922, 925))
    assert rows[923]["sanitised"] == "[TERM] [EMAIL]"  # an entity that is seen once
    assert "1.2" not in rows[924]["sanitised"] and rows[924]["sanitised"].startswith("[TERM], c/o [IP].[IP] or [PHONE]")


def test_sanitise_repeats_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([(1, "Otto a@b.co", "x", 5), (1, "Otto a@b.co", "y", 6), (1, "other", "x", 7), (None, "Otto", "z", 8), (2, None, None, None)], "doc_id long, text string, fp string, d long")
    rows = sorted(((r["doc_id"] or 0, r["spans"], r["sanitised"]) for r in pii.sanitise(df).collect()), key=str)
    assert rows == sorted([(1, "email:5:11", "Otto [EMAIL]")] * 2 + [(1, "", None), (0, "", None), (2, "", None)], key=str)
    assert pii.sanitise(df.limit(0)).count() == 0 and pii.sanitise(df.limit(0), with_text=False).count() == 0


def test_very_long_texts(spark):
    """A million digits, ten thousand addresses, a hundred thousand words."""
    texts = ["7" * 1_000_000, "ab@c.de " * 10_000, "Wort " * 100_000 + "x@y.zz", "1.2.3.4 " * 5_000]
    t = time.time()
    rows = {r["doc_id"]: r for r in pii.sanitise(docs(spark, texts), with_text=False).collect()}
    assert [rows[1]["n_email"], rows[3]["n_ip"], rows[0]["n_card"], rows[2]["n_email"]] == [10_000, 5_000, 0, 1]
    assert time.time() - t < 90


# ---------------------------------------------------------------- token shards
def test_feistel_is_a_permutation():
    for size in (1, 2, 3, 10, 257, 5000):
        for key in (0, 7):
            assert sorted(token_shards.feistel(np.arange(size), size, key).tolist()) == list(range(size))
    assert token_shards.feistel(np.arange(50), 50, 1).tolist() != token_shards.feistel(np.arange(50), 50, 2).tolist()


def test_shards_round_trip(spark, tmp_path):
    texts = [None, "", "short", "é😀 " * 400, "word " * 3000]
    df = docs(spark, texts)
    places, path = token_shards.write_shards(df, f"file://{tmp_path}/s", seq_len=64)
    rows = places.collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    enc = token_shards.encoder(open(token_shards.VOCABULARY, "rb").read())
    parts = defaultdict(dict)
    order = []
    for slot, doc, num, ids in token_shards.read_slots(spark, path, seq_len=64):
        parts[doc][num] = ids
        order.append((slot, doc, num))
    assert order == sorted((r["slot"], r["doc_id"], r["seq"]) for r in rows)
    for i, t in enumerate(texts):
        if t:
            ids = [int(x) for n in sorted(parts[i]) for x in parts[i][n]]
            assert ids[-1] == token_shards.END and enc.decode(ids[:-1]) == t
    assert [s for s, *_ in token_shards.read_slots(spark, path, 3, 2, seq_len=64)] == [3, 4]
    assert len(places.select("shard").distinct().collect()) > 1
    assert token_shards.write_shards(df.limit(0), f"file://{tmp_path}/t")[0].count() == 0


def test_training_order_is_the_permutation(spark, tmp_path):
    """Slots are the ranks of the permuted indices; ids may be null, repeated or as far apart as can be."""
    texts = ["one two three " * 40, "x", None, "y " * 900, "", "x", "z " * 100]
    ids = [9_000_000_000_000_000_000, -9_000_000_000_000_000_000, 1, None, 2, -9_000_000_000_000_000_000, None]
    df = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts)], "doc_id long, text string, slot int").coalesce(1)
    places, path = token_shards.write_shards(df, f"file://{tmp_path}/o", seq_len=32, seed=5)
    enc = token_shards.encoder(open(token_shards.VOCABULARY, "rb").read())
    rows = [(i, t) for i, t in zip(ids, texts) if t]
    width = max(len(t.encode()) for _, t in rows) // 32 + 2
    seqs = [(r * width + j, i, j) for r, (i, t) in enumerate(rows) for j in range(-(-(len(enc.encode_ordinary(t)) + 1) // 32))]
    rank = np.argsort(token_shards.feistel(np.array([x for x, _, _ in seqs]), len(rows) * width, 5))
    want = [(-1 if seqs[k][1] is None else seqs[k][1], seqs[k][2]) for k in rank]
    assert [(d, n) for _, d, n, _ in token_shards.read_slots(spark, path, seq_len=32)] == want
    assert sorted(r["slot"] for r in places.collect()) == list(range(len(want)))
