"""Nulls, empty and very long texts, ties, repeated rows, empty tables and columns with the operators' own names."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, langid, line_dedup, ngram_join, packing, suffix_dedup, token_shards, toxicity
from test_exact_ops import _align, _cut, _lines

LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(60_000))
ITEM = "seven quick foxes jumped over nine lazy dogs while eleven cats watched them from twelve walls"
TEXTS = [None, "", " \n\t", "one line", "one line", "one line\nother line\nthird line of some length", "other line\nthird line of some length", LONG, LONG + " tail", (ITEM + " and so on ") * 300, ITEM.replace("quick", "slow"), "é😀 " * 400, "b" * 30_000]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "one line"), (3, "another text under this id"), (None, ITEM), (None, None)]
EXTRA = "fp long, id string, n int, c int, maybe boolean, shard int, slot long, bucket int, told string, spans string, _mr_id long, _mr_fp long, _mr_text string, _mr_gone int, score double, toxic int, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def table(spark):
    names = [x.split()[0] for x in EXTRA.split(", ")]
    plain = spark.createDataFrame(ROWS, "doc_id long, text string")
    return plain.select("*", *(F.lit(None).cast(x.split()[1]).alias(n) if n != "n_chars" else F.length("text").cast("long").alias(n) for x, n in zip(EXTRA.split(", "), names)))


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM, 0.5), (2, None, 0.5), (3, "", 0.5), (1, ITEM, 0.7)], "item_id long, text string, score double")


def plain(rows):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None, r["text"] or "") for r in rows))


def test_lines(table):
    out = line_dedup.line_dedup(table, alone=None)
    assert out.columns[: len(table.columns)] == table.columns
    texts = [t for _, t in ROWS]
    # rows that repeat an id and text have one place, so they count as one
    want = _lines(texts[: len(TEXTS)], 2)
    got = {r["doc_id"]: r["text"] for r in out.where("doc_id is not null and doc_id <> 3").collect()}
    assert got == {i: t for i, t in want.items() if i != 3} and out.count() == len(ROWS)


def test_jaccard_and_suffixes(spark, table):
    comps = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(table).collect() if r["doc_id"] is not None}
    assert comps[4] == comps[3] == 3 and comps[8] == comps[7] == 7 and comps[0] == 0 and comps[2] == 2
    kept = ngram_join.drop_near_copies(table)
    assert kept.columns == table.columns
    left = plain(kept.collect())
    assert (False, 3, False, "another text under this id") in left and (False, 3, False, "one line") in left and not any(i in (4, 8) for _, i, _, _ in left) and sum(n for n, *_ in left) == 2
    one = table.where("doc_id <> 3 or text = 'one line'").dropDuplicates(["doc_id"])
    rows = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(one).collect()}
    want = _cut(TEXTS, 200)
    assert {i: rows[i] for i in range(len(TEXTS))} == want
    assert suffix_dedup.suffix_dedup(table).count() == len(ROWS)


def test_decontamination(table, bench):
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect()}
    assert found == {(9, 1), (10, 1), (None, 1)}
    out = decontaminate.decontaminate(table, bench)
    assert out.columns == table.columns and plain(out.collect()) == plain([{"doc_id": i, "text": t} for i, t in ROWS if not (t and "foxes" in t)])


def test_alignments_by_brute_force(spark):
    """All pairs of documents and items: those whose best alignment reaches half of the item, with its score."""
    rnd = random.Random(3)
    word = lambda: f"v{rnd.randrange(3000)}"
    items = [[word() for _ in range(rnd.randint(8, 24))] for _ in range(12)]
    docs = []
    for i in range(80):
        body = [word() for _ in range(rnd.randint(5, 60))]
        if i % 2:
            copy = list(rnd.choice(items))
            for _ in range(rnd.randint(0, len(copy) // 5)):
                k = rnd.randrange(len(copy))
                copy[k : k + 1] = rnd.choice([[], [word()], [copy[k], word()]])
            cut = rnd.choice([0, 0, len(copy) // 4])
            at = rnd.randrange(len(body) + 1)
            body[at:at] = copy[cut:]
        docs.append(body)
    grams = lambda w: {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    want = {(d, i): round(_align(x, body) / (2 * len(x)), 6) for d, body in enumerate(docs) for i, x in enumerate(items) if grams(x) & grams(body) and _align(x, body) >= len(x)}
    df = spark.createDataFrame([(d, " ".join(b)) for d, b in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]): round(r["score"], 6) for r in decontaminate.contaminated(df, bench).collect()} == want and len(want) > 25


def test_models_and_lengths(spark, table):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = toxicity.train(docs, labels)
    scores = toxicity.score(table, model).collect()
    assert len(scores) == len(ROWS) and all(0 <= r["score"] <= 1 for r in scores)
    langs = {r["doc_id"]: r["lang_pred"] for r in langid.identify(table, langid.train(docs)).collect()}
    assert langs[0] == langs[1] == langs[2] == "und" and langs[7] != "und"
    lengths = token_shards.token_lengths(table)
    assert lengths.count() == len(ROWS) and lengths.where("n_tokens = 0").count() == 3
    packed = packing.best_fit_packing(table)
    assert packed.agg(F.sum("n_tokens")).first()[0] == sum(len((t or "").encode()) for _, t in ROWS)
    places, _ = token_shards.write_shards(table, seq_len=128)
    assert sorted(r["slot"] for r in places.select("slot").collect()) == list(range(places.count()))


def test_stages_on_awkward_and_empty_tables(spark, table, bench, tmp_path):
    import corpus_pipeline as cp

    bench.write.parquet(f"file://{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(5, 0, 1), (7, 1, 0), (None, 1, 1), (5, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    for start in (table, table.limit(0)):
        docs = start
        for name, stage in cp.STAGES:
            out = stage(spark, docs, f"file://{tmp_path}")
            if name != cp.STAGES[-1][0]:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
                docs = spark.createDataFrame(out.collect(), out.schema)
            else:
                total = sum(len((r["text"] or "").encode()) for r in docs.collect())
                assert (out.agg(F.sum("n_tokens")).first()[0] or 0) == total
        assert (docs.count() > 5) == (start is table)
