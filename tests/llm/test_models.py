"""Trained operators: held-out accuracy and awkward inputs; the pipeline's stages."""

import math
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from millrace.llm import common, langid, toxicity
from millrace.llm.common import materialize

SF = "/root/testdata/sf0.01"


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.op9_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert out.where("score < 0 or score > 1").count() == 0


def test_language_odd_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    model = langid.train(docs)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? 😀"), (4, "é"), (5, "the " * 20000), (5, "the")], "doc_id long, text string")
    rows = [(r["doc_id"], r["lang_pred"]) for r in langid.identify(odd, model).collect()]
    assert [p for d, p in sorted(rows)[:3]] == ["und"] * 3 and all(p != "und" for d, p in rows if d > 3) and len(rows) == 6
    assert langid.identify(odd.limit(0), model).count() == 0 and langid.train(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langid.identify(odd, None).collect()} == {"und"}


def chars_of(words):
    n = np.array([len(w) for w in words])
    s = np.cumsum(n) - n
    return langid.word_chars(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), s, s + n)


def kneser_ney(words, order, alphabet):
    """Log probability of a word by interpolated Kneser-Ney, from dictionaries."""
    count = [defaultdict(float) for _ in range(order + 1)]
    longer = [defaultdict(set) for _ in range(order + 1)]
    for w, c in words.items():
        x = f"\0{w.lower()}\0"
        for n in range(1, order + 1):
            for i in range(max(1, n - 1), len(x)):
                g = x[i - n + 1 : i + 1]
                count[n][g] += c if n == order or i == n - 1 else 0
                if n < order and i >= n:
                    longer[n][g].add(x[i - n : i + 1])
    for n in range(1, order):
        for g, more in longer[n].items():
            count[n][g] += len(more)
    total, kinds = defaultdict(float), defaultdict(int)
    for n in range(1, order + 1):
        for g, c in count[n].items():
            total[n, g[:-1]] += c
            kinds[n, g[:-1]] += 1

    def p(g):
        n = len(g)
        lower = 1 / alphabet if n == 1 else p(g[1:])
        t = total.get((n, g[:-1]), 0)
        return lower if not t else max(count[n].get(g, 0) - langid.DISCOUNT, 0) / t + langid.DISCOUNT * kinds[n, g[:-1]] / t * lower

    def score(w):
        x = f"\0{w.lower()}\0"
        return sum(math.log(p(x[max(0, i - order + 1) : i + 1])) for i in range(1, len(x)))

    return score


@pytest.mark.parametrize("order", [2, 3, 5])
def test_word_scores_are_kneser_ney(order):
    rnd = random.Random(order)
    langs = [{"".join(rnd.choice(abc) for _ in range(rnd.randint(1, 7))): float(rnd.randint(1, 9)) for _ in range(60)} for abc in ("abcdÉ", "abxyß", "语言模型ab")]
    model = langid.Model(["p", "q", "r"], order)
    parts = [chars_of(sorted(x)) for x in langs]
    model.train([c for c, _ in parts], [a for _, a in parts], [np.array([x[w] for w in sorted(x)]) for x in langs])
    alphabet = 256 + 2 * len(np.unique(np.concatenate([c for c, _ in parts])))
    probes = [w for x in langs for w in x] + ["zzz", "a", "abcdabcdabcd", "语b", "Éé", "q" * 30]
    got = model.word_scores(*chars_of(probes))
    for k, x in enumerate(langs):
        score = kneser_ney(x, order, alphabet)
        assert np.allclose(got[:, k], [score(w) for w in probes], rtol=1e-4, atol=1e-3)


def test_words_are_letter_runs():
    texts = ["Été «naïf»… l’eau", "語言 123x", "", "😀", "a\u00adb", "x" * 5]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    chars, h, s, e, text, _ = langid._words_of(data, offs)
    want = [(i, m) for i, t in enumerate(texts) for m in regex.findall(r"\p{L}+", t)]
    assert [(int(i), "".join(map(chr, chars[a:b]))) for i, a, b in zip(text, s, e)] == want


def test_language_with_one_text(spark):
    """A language of a single text, and one whose first text is far longer than the bound, are learned."""
    rows = [(i, "the cat sat on the mat and the dog", "en") for i in range(40)] + [(100, "der hund und die katze sind nicht hier", "de")] + [(200 + i, "le chat est sur la table avec le chien " * 200, "fr") for i in range(3)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), train_bytes=500)
    odd = spark.createDataFrame([(1, "the dog and the cat"), (2, "die katze und der hund"), (3, "le chien est sur la table")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identify(odd, model).collect()} == {1: "en", 2: "de", 3: "fr"}


def test_probabilities_sum_to_one():
    """The interpolated distribution over what follows a context is one."""
    ch, at = chars_of(["abba", "abc", "cab", "a"])
    model = langid.Model(["x"], 4)
    model.train([ch], [at], [np.array([3.0, 1.0, 2.0, 5.0])])
    for context in ("", "a", "ab", "abb"):
        symbols = [c for c in range(1, 264) if langid.tables()[1][c] == c]  # capitals count as small letters
        tail = [context + chr(c) for c in symbols] + [context]  # the last one stands for the closing mark
        chars, starts = chars_of(tail)
        hs = langid.gram_hashes(chars, starts, 4)
        last = starts + len(context) + 1
        k = min(len(context) + 2, 4)
        p = np.exp(model.log_probs([h[last] for h in hs], [np.zeros(len(last), np.uint64), *[h[last - 1] for h in hs]], k))[:, 0]
        assert p[[symbols.index(b) for b in b"abc"]].sum() + p[-1] > 0.9 and 0.9 < p.sum() < 1.001


def test_toxicity_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = toxicity.op8_toxicity(spark, SF).join(labels, "doc_id")
    held = out.where("held_out").agg(F.count_if((F.col("predicted") == 1) & (F.col("toxic") == 1)).alias("tp"), F.sum("predicted").alias("p"), F.sum("toxic").alias("t")).first()
    assert held["tp"] / held["p"] > 0.75 and held["tp"] / held["t"] > 0.6
    assert out.where("score < 0 or score > 1 or (score >= 0.7) <> (predicted = 1)").count() == 0


@pytest.mark.parametrize("a,b", [("wretch", "wr3tch"), ("vermin", "v.e.r.m.i.n"), ("aab", "baab"), ("x", "y"), ("abcdefgh", "hgfedcba"), ("été", "ete")])
def test_kernel_counts_gapped_subsequences(a, b):
    """The kernel product of two units by enumeration of all subsequences of four within the span."""

    def coded(t):
        raw = np.frombuffer(t.encode(), np.uint8)
        return toxicity.codes(raw, np.array([0]), np.array([len(raw)]))

    def weights(c):
        out, norm = defaultdict(float), 0.0
        x = c[0].tolist()
        for i in combinations(range(len(x)), 4):
            if i[3] - i[0] <= toxicity.SPAN and all(0 < x[j] != 28 for j in i):
                w = toxicity.DECAY ** (i[3] - i[0] + 1)
                out[tuple(x[j] for j in i)] += w
                norm += w * w
        return {k: v / math.sqrt(max(norm, 1e-12)) for k, v in out.items()}

    ca, cb = coded(a), coded(b)
    x, y = weights(ca), weights(cb)
    number = toxicity.numbering(np.concatenate([ca, cb]))
    got = toxicity.project(cb, number, toxicity.features(ca, number).T)[0, 0]
    assert abs(got - sum(v * y.get(k, 0) for k, v in x.items())) < 1e-5


def test_scores_do_not_depend_on_batches(spark):
    """Units that a task has met before score as they do anew."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    texts = pa.array([r["text"] for r in docs.select("text").limit(200).collect()])
    whole, memo = toxicity._scores(model, texts, common.Memo(1)), common.Memo(1)
    memo.LIMIT = 50
    assert np.allclose(whole, np.concatenate([toxicity._scores(model, texts.slice(i, 7), memo) for i in range(0, 200, 7)]))


def test_toxicity_tolerates_insertions():
    rng = np.random.default_rng(0)
    letters = np.array(list("abcdefghijklmnop"))
    clean = ["".join(rng.choice(letters, rng.integers(2, 9))).encode() for _ in range(300)]
    docs = [(int(i % 4 == 0), sorted({*(clean[j] for j in rng.integers(0, 300, 30)), *([b"wretch", b"vermin"][i % 8 == 0 :][:1] if i % 4 == 0 else [])})) for i in range(400)]
    model = toxicity.fit(docs, {0: 1.0, 1: 1.0})

    def score(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        t, s, e, _ = toxicity.units(raw, np.array([0, len(raw)]))
        f = model.margins(toxicity.codes(raw, s, e))
        return model.scores(toxicity.evidence(1, t, np.arange(len(f)), f))[0]

    for bad in ("wretch", "a w r e t c h b", "wre-tch!", "VER.MIN", "v3rmin"):
        assert score(bad) > 0.5, bad
    assert score("a nice day") < 0.3 and score("x") < 0.3


def test_toxicity_odd_texts(spark):
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "a" * 100000), (4, "you idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(odd, labels) is None and toxicity.score(odd, None).count() == 5
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert len(rows) == 5 and rows[4] > rows[1] and toxicity.score(odd.limit(0), model).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols, size = docs.columns, docs.count()
    for name, stage in cp.STAGES:
        before = docs
        docs = materialize(stage(spark, docs, SF), name)
        if name != cp.STAGES[-1][0]:
            assert docs.columns == cols and docs.dtypes == before.dtypes
            assert docs.select("doc_id").distinct().count() == docs.count() <= size
            size = docs.count()
        else:
            total = before.agg(F.sum(F.octet_length("text"))).first()[0]
            assert docs.agg(F.sum("n_tokens")).first()[0] == total
    assert size > 700
