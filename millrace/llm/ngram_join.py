"""Set-similarity self-join on word shingles (Jaccard >= 3/4) with token-combination prefixes.

Order of a set's tokens: never seen in another set, then rare, then frequent, each by
hash. Two sets whose overlap reaches their bound share at least k tokens within their
first ``n - bound + k`` tokens. Rare tokens of that prefix are indexed one by one. The
frequent tokens are split by hash into g groups and indexed in pairs inside a group:
with k = g + 1, sets that share no rare token must share two tokens of one group. g
follows the size of the set (bands of ratio 4/3, each set indexed in its own band and
the next, so that any two similar sets meet in one).

Document counts of all shingles come from one pass in which every map task sends sorted
64-bit arrays, one per hash range. The reducers return two bitmaps of fixed size
(``SEEN_BITS``, ``FREQ_BITS``): "held by two sets" and "held by more than RARE_DF sets".
A wrong bit only moves a token to another class, the same one for all sets, so that
results stay exact when a bitmap fills; only the pruning gets weaker.

Copies are merged by a 128-bit fingerprint of the set first. Candidates then come in two
rounds: each posting list against its member with the fewest tokens of its own, and after the components of these
links, only pairs from different components. A group of n near copies so costs about n
checks and not n*n/2, and no link between two components is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

U64 = C.U64
WIDTH = 5
RARE_DF = 32
SEEN_BITS, FREQ_BITS = C.SEEN_BITS, C.FREQ_BITS
_COEF = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 16, dtype=np.uint64) | U64(1)
_K1, _K2 = U64(0x1B873593CC9E2D51), U64(0x52DCE729DA3ED7B5)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = WIDTH):
    """Sorted distinct shingle hashes of each text of a block."""
    h, _, _, first = C.words(data, offs)
    m = len(h) - width + 1
    if m > 0:
        s = h[:m] * _COEF[0]
        for j in range(1, width):
            s += h[j : j + m] * _COEF[j]
        s = C.mix(s)
    for i in range(len(offs) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            v = np.sort(s[a : b - width + 1])
            keep = np.empty(len(v), bool)
            keep[0] = True
            np.not_equal(v[1:], v[:-1], out=keep[1:])
            yield v[keep]
        elif b > a:
            yield C.mix(np.add.reduce(h[a:b] * _COEF[: b - a], keepdims=True) + _COEF[8 + b - a])
        else:
            yield h[:0]


def fingerprint(v: np.ndarray) -> tuple[int, int]:
    if not len(v):
        return 0, 0
    a = np.add.reduce(C.mix(v ^ _K1))
    b = np.add.reduce(C.mix(v ^ _K2))
    return int(np.int64(a.astype(np.int64))), int(np.int64(b.astype(np.int64)))


def _count_map(buckets: int, width: int):
    def run(batches):
        seen: set = set()
        held: list[np.ndarray] = []
        size = 0

        def flush():
            return C.bucket_blobs(np.sort(np.concatenate(held)), buckets)

        for batch in batches:
            for _, _, data, offs in C.utf8_blocks(batch.column(0)):
                for v in shingle_sets(data, offs, width):
                    if not len(v):
                        continue
                    fp = fingerprint(v)
                    if fp in seen:
                        continue
                    seen.add(fp)
                    held.append((v & ~U64(0xFFFF)) | U64(fp[0] & 0xFFFF))
                    size += len(v)
                    if size > 3_000_000:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return run


def token_classes(texts: DataFrame, width: int, rare_df: int) -> tuple[bytes, bytes]:
    """The two bitmaps; their size is fixed, whatever the corpus."""
    buckets = C.bucket_count(texts.sparkSession)
    return C.class_bitmaps(texts.mapInArrow(_count_map(buckets, width), "bucket int, blob binary"), buckets, rare_df)


def band_of(n: int) -> int:
    return int(np.floor(np.log(n) / np.log(4 / 3) + 1e-9))


def groups_of(band: int) -> int:
    """g of a band: a quarter of the smallest size that is indexed in it."""
    return int((4 / 3) ** (band - 1) / 4)


def signatures(v: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Index keys of a set v with token classes 0 (no other set), 1 (rare), 2 (frequent)."""
    n = len(v)
    bound = (3 * n + 3) // 4
    order = np.lexsort((v, cls))
    v, cls = v[order], cls[order]
    b = band_of(n)
    longest = min(n, n - bound + 1 + groups_of(b + 1))
    if not (cls[:longest] == 2).any():
        longest = n - bound + 1
        return C.mix(v[:longest][cls[:longest] == 1])
    out = [C.mix(v[:longest][cls[:longest] == 1])]
    for c in (b, b + 1):
        g = groups_of(c)
        part = v[: min(n, n - bound + 1 + g)][cls[: min(n, n - bound + 1 + g)] == 2]
        if not g:
            out.append(C.mix(part ^ _K1))
            continue
        grp = (part >> U64(7)) % U64(g)
        o = np.lexsort((part, grp))
        part, grp = part[o], grp[o]
        for d in range(1, len(part)):
            same = grp[d:] == grp[:-d]
            if not same.any():
                break
            x, y = part[:-d][same], part[d:][same]
            out.append(C.mix(x * _COEF[1] + y * _COEF[2] + U64((c + 1) * int(_K2) & (1 << 64) - 1)))
    return np.unique(np.concatenate(out))


def _sign_map(seen_b, freq_b, width: int):
    def run(batches):
        seen, freq = np.frombuffer(seen_b.value, np.uint8), np.frombuffer(freq_b.value, np.uint8)
        done: set = set()
        for batch in batches:
            ids = batch.column(1)
            for lo, hi, data, offs in C.utf8_blocks(batch.column(0)):
                n, m, s1, s2, sets, sigs = [], [], [], [], [], []
                for v in shingle_sets(data, offs, width):
                    fp = fingerprint(v)
                    n.append(len(v))
                    s1.append(fp[0])
                    s2.append(fp[1])
                    mine = None
                    if len(v) and fp not in done:
                        hit = C.bit(seen, v, SEEN_BITS)
                        held = int(hit.sum())
                        if held >= (3 * len(v) + 3) // 4:
                            done.add(fp)
                            mine = v
                            m.append(held)
                            sigs.append(C.as_long(signatures(v, hit * (np.uint8(1) + C.bit(freq, v, FREQ_BITS)))))
                    if mine is None:
                        sigs.append(None)
                        m.append(0)
                    sets.append(None if mine is None else C.as_long(mine))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                    ["doc_id", "n", "m", "s1", "s2", "toks", "sigs"],
                )

    return run


LINKED = "100 * i >= 75 * (na + nb - i)"


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, i): exact overlaps of pairs of sets."""
    left = sets.select(F.col("rep").alias("a"), F.col("toks").alias("ta"))
    right = sets.select(F.col("rep").alias("b"), F.col("toks").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"), F.size(F.array_intersect("ta", "tb")).alias("i"))


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, rare_df: int = RARE_DF) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links), one row per input row.

    Null and empty texts have no shingles and link with nothing. Rows with equal sets link,
    whatever their ids; a null id never names a component. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(docs[text].cast("string").alias("text"), docs[key].cast("long").alias("doc_id"))
    seen, freq = token_classes(texts.select("text"), width, rare_df)
    sc = spark.sparkContext
    signed = texts.mapInArrow(_sign_map(sc.broadcast(seen), sc.broadcast(freq), width), "doc_id long, n long, m long, s1 long, s2 long, toks array<long>, sigs array<long>")
    t = C.materialize(signed, "sets")
    classes = t.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    classes = C.materialize(classes, "classes")
    sets = t.where("toks is not null").select("s1", "s2", "n", "m", "toks", "sigs").dropDuplicates(["s1", "s2"]).join(classes.where("rep is not null"), ["s1", "s2"]).select("rep", "n", "m", "toks", "sigs")
    sets = C.materialize(sets, "reps")
    # m, the tokens of a set that other sets hold, bounds its overlap with any; the set with the fewest of its own heads a list
    posts = sets.select("rep", "n", "m", F.explode("sigs").alias("sig"))
    heads = posts.groupBy("sig").agg(F.min(F.struct(((F.col("n") - F.col("m")) / F.col("n")).alias("own"), "rep", "n", "m")).alias("head"), F.count("*").alias("c"))
    heads = heads.where("c > 1").select(F.col("sig").alias("k"), F.col("head.rep").alias("a"), F.col("head.n").alias("na"), F.col("head.m").alias("ma"))
    close = "4 * least(na, nb) >= 3 * greatest(na, nb) and 7 * least(ma, mb) >= 3 * (na + nb)"
    first = posts.select("sig", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("m").alias("mb")).join(heads, (F.col("sig") == F.col("k")) & F.expr(f"a <> b and {close}"))
    first = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).groupBy("a", "b").agg(F.lit(1).alias("x")).select("a", "b")
    first = C.materialize(overlaps(C.materialize(first, "stars"), sets), "links1")
    comps = C.materialize(C.connected_components(first.where(LINKED).select("a", "b"), "cc1"), "comps1")
    # second round: posting lists that still span several components
    member = sets.select("rep", "n", "m", "sigs").join(comps, F.col("rep") == F.col("node"), "left").select("rep", "n", "m", F.coalesce("comp", "rep").alias("comp"), F.explode("sigs").alias("sig"))
    own = ((F.col("n") - F.col("m")) / F.col("n")).alias("own")
    split = member.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct(own, "rep")).alias("head")).where("lo < hi").select(F.col("sig").alias("k"), F.col("head.rep").alias("c"))
    # lists of one head are taken together: each member once, with the keys it shares lists by
    open_ = member.join(split, F.col("sig") == F.col("k")).groupBy("c", "rep").agg(F.first("n").alias("n"), F.first("m").alias("m"), F.first("comp").alias("comp"), F.collect_list("sig").alias("sigs"))
    # i: overlap with the head, known from the first round; what two sets share lies within it or outside it
    known = first.select(F.col("a").alias("p"), F.col("b").alias("q"), "i").unionByName(first.select(F.col("b").alias("p"), F.col("a").alias("q"), "i"))
    open_ = open_.join(known, (F.col("rep") == F.col("p")) & (F.col("c") == F.col("q")), "left").withColumn("i", F.when(F.col("rep") == F.col("c"), F.col("n")).otherwise(F.col("i")))
    open_ = open_.join(comps.select(F.col("node").alias("h"), F.col("comp").alias("hc")), F.col("c") == F.col("h"), "left")
    open_ = C.materialize(open_.select("c", "rep", "n", "m", "comp", "sigs", "i", F.coalesce("hc", "c").alias("hc")), "open")
    # of two sets from different components, one at least is outside the head's
    x = open_.where("comp <> hc").select("c", F.col("rep").alias("x"), F.col("n").alias("na"), F.col("m").alias("ma"), F.col("comp").alias("ca"), F.col("i").alias("ia"), F.col("sigs").alias("sa"))
    y = open_.select(F.col("c").alias("k"), F.col("rep").alias("y"), F.col("n").alias("nb"), F.col("m").alias("mb"), F.col("comp").alias("cb"), F.col("i").alias("ib"), F.col("sigs").alias("sb"), F.col("hc").alias("hb"))
    bound = "coalesce(7 * (least(ia, ib) + least(ma - ia, mb - ib)) >= 3 * (na + nb), true)"
    more = x.join(y, (F.col("c") == F.col("k")) & F.expr(f"(cb = hb or ca < cb) and ca <> cb and {close} and {bound} and arrays_overlap(sa, sb)"))
    more = C.materialize(more.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).groupBy("a", "b").agg(F.lit(1).alias("z")).select("a", "b"), "more")
    links2 = overlaps(more.join(first, ["a", "b"], "left_anti"), sets).where(LINKED).select("a", "b")
    final = C.connected_components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(links2), "cc2")
    named = classes.join(C.materialize(final, "comps2"), F.col("rep") == F.col("node"), "left").select("s1", "s2", F.coalesce("comp", "rep").alias("component"))
    out = t.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component stays: the one with the smallest id. Rows that repeat an id with one text count as one,
    rows that repeat an id with different texts are documents of their own; null ids stay. Other columns pass through, whatever their names."""
    id_, fp_ = C.free(docs.columns, "_mr_id"), C.free(docs.columns, "_mr_fp")
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(docs["text"].cast("string")).alias("fp"), docs["text"].cast("string").alias("text")).where("id is not null")
    # ids with several texts: each of these rows gets a number of its own, the others keep their id
    several = C.materialize(rows.groupBy(F.col("id").alias("i")).agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("i"), "several")
    nulls = docs.where(docs["doc_id"].isNull())
    key = F.col("doc_id").cast("long")
    if several.isEmpty():
        keep = jaccard_components(rows.select(F.col("id").alias("doc_id"), "text")).where("doc_id = component_id").select(F.col("doc_id").alias(id_)).distinct()
        return docs.join(keep, key == F.col(id_), "left_semi").dropDuplicates(["doc_id"]).unionByName(nulls)
    own = rows.join(several, F.col("id") == F.col("i"), "left").select(F.when(F.col("i").isNull(), F.col("id")).otherwise(F.xxhash64("id", "fp")).alias("doc_id"), "text", "id", "fp")
    comps = jaccard_components(own.select("doc_id", "text")).select(F.col("doc_id").alias("n"), "component_id")
    names = own.where(F.col("doc_id") != F.col("id")).select("doc_id", "id", "fp").distinct()
    member = comps.join(names, F.col("n") == F.col("doc_id"), "left")
    # the smallest id, then fingerprint (null: the only text of its id)
    keep = member.groupBy("component_id").agg(F.min(F.struct(F.coalesce("id", "n").alias("id"), "fp")).alias("x")).select(F.col("x.id").alias(id_), F.col("x.fp").alias(fp_))
    of_text = C.free(docs.columns, "_mr_text")
    marked = docs.withColumn(of_text, F.xxhash64(F.col("text").cast("string")))
    with_id = marked.join(keep, (key == F.col(id_)) & (F.col(fp_).isNull() | (F.col(of_text) == F.col(fp_))), "left_semi")
    return with_id.dropDuplicates(["doc_id", of_text]).drop(of_text).unionByName(nulls)


def op3_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_ngram_jaccard_join": op3_ngram_jaccard_join}

_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D]', ' ', 'g'), ' '), lambda x: x <> '')"
SQL = {
    "op3_ngram_jaccard_join": f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = w.doc_id
"""
}
