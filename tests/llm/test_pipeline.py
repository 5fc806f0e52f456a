"""The pipeline's stages, each against a brute-force version on its own input."""

import re
from collections import defaultdict

import corpus_pipeline as cp
from millrace.llm import packing, toxicity
from millrace.llm.common import materialize
from test_exact_ops import _align, _classes, best_fit

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict() for r in df.orderBy("doc_id").collect()]


def without_toxic(spark, docs):
    """By the scores of the whole table, where the stage filters rows as it reads them."""
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    return [r for r in rows_of(docs) if scores[r["doc_id"]] < 0.7]


def without_repeated_lines(rows):
    """Runs of two full lines, and lines of 100 bytes, that occur earlier."""
    seqs = [(r, [(n, x) for n, x in enumerate((r["text"] or "").split("\n")) if x.strip(" ")]) for r in rows]
    first, gone = {}, defaultdict(set)
    runs = lambda s: [(tuple(x for _, x in s[k : k + 2]), k, {n for n, _ in s[k : k + 2]}) for k in range(len(s) - 1)] + [((x, None), k, {n}) for k, (n, x) in enumerate(s) if len(x.strip(" ").encode()) >= 100]
    for r, s in seqs:
        for run, k, _ in runs(s):
            first.setdefault(run, (r["doc_id"], k))
    for r, s in seqs:
        for run, k, lines in runs(s):
            if first[run] != (r["doc_id"], k):
                gone[r["doc_id"]] |= lines
    out = []
    for r in rows:
        cut = gone[r["doc_id"]]
        text = "\n".join(x for n, x in enumerate((r["text"] or "").split("\n")) if n not in cut)
        if not cut:
            out.append(r)
        elif text.strip(" "):
            out.append(r | {"text": text, "n_chars": len(text)})
    return out


def without_near_copies(rows):
    comps = _classes([r["text"] for r in rows])
    return [r for i, r in enumerate(rows) if comps[i][1] == i]


def without_leaks(spark, rows):
    words = lambda t: re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = []
    for r in rows:
        w = words(r["text"])
        g = grams(w)
        # half of an item's score needs a quarter of its words at the least: the others need no alignment
        close = [x for x in items if grams(x) & g and 2 * len(set(x) & set(w)) >= 0.5 * len(set(x))]
        if not any(_align(x, w) >= len(x) for x in close):
            out.append(r)
    return out


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    brute = {
        "toxicity": lambda d: without_toxic(spark, d),
        "line_dedup": lambda d: without_repeated_lines(rows_of(d)),
        "ngram_jaccard_join": lambda d: without_near_copies(rows_of(d)),
        "benchmark_decontamination": lambda d: without_leaks(spark, rows_of(d)),
    }
    for name, stage in cp.STAGES[:-1]:
        want = brute[name](docs)
        docs = materialize(stage(spark, docs, SF), name)
        assert rows_of(docs) == want, name
        sizes.append(len(want))
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) > 3
    # packing: the cheapest set of sizes, every piece in one place, bins as full as best fit makes them
    places = cp.STAGES[-1][1](spark, docs, SF).collect()
    lengths = [n for r in rows_of(docs) for t in [len((r["text"] or "").encode())] for n in [8192] * (t // 8192) + [t % 8192] * (t % 8192 > 0)]
    assert sorted(p["n_tokens"] for p in places) == sorted(lengths)
    filled, capacity = defaultdict(int), {}
    for p in places:
        filled[p["bin_id"]] += p["n_tokens"]
        capacity[p["bin_id"]] = p["capacity"]
    assert all(capacity[b] == packing.downsize(n, packing.SIZES) for b, n in filled.items())
    hist = {n: lengths.count(n) for n in lengths}
    chosen = packing.best_plan(hist, packing.SIZES)[2]
    assert sorted(filled.values()) == best_fit(lengths, (*chosen, 8192))
