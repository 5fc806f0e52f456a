"""Exact removal of repeated byte strings by a sparse suffix array.

Every string of ``length`` bytes belongs to one anchor: the leftmost smallest hash among
the 32-byte grams that start in it. Equal strings have equal anchors at equal places, so
only suffixes that start at anchors (about one in 85 bytes) need sorting.

1. A pass over all texts sends the hashes of the anchors' keys (the bytes that all strings
   of an anchor, or of its near or far half, have in common) as packed arrays; a bitmap of
   fixed size says which keys occur twice. A second pass gives the places of these with a
   hash of the context, the run of bytes of all strings that the anchor stands for. Counts
   per (key, context) are combined before the shuffle; a context that occurs twice is a
   repeat as a whole, and a key with one context needs nothing else.
2. Keys with several contexts: one representative of each context brings its bytes as a suffix
   (from the key on) and what precedes it, backwards. Sampled splitters deal the suffixes into ranges
   by their leading tokens; each bucket is sorted by multikey quicksort on 8-byte tokens, suffixes
   and what precedes them. Common prefixes of neighbours in both orders decide: a string that starts d
   bytes before the key repeats if another one lies within the same run of neighbours that agree
   in ``length`` - d bytes, and within the same run of d bytes backwards.
3. Splitters may part a run, however many suffixes share it. The strings of the runs that touch an end
   of a bucket are carried on by their hashes, some neighbouring ones in a row with the hash of what they have in
   common; those whose common part another bucket has too are compared one by one.
4. Spans are merged per document and cut from its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

U64 = C.U64
LENGTH = 200
GRAM = 32
#: Suffixes of a bucket, on average.
BUCKET = 20_000
_BYTE = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, 256, dtype=np.uint64)


def _window_min_first(x: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost minimum of each window of w values (two passes of running minima)."""
    n = len(x)
    m = n - w + 1
    pad = (-n) % w
    y = np.concatenate([x, np.full(pad, ~U64(0))]).reshape(-1, w)
    idx = np.arange(n + pad).reshape(-1, w)
    fwd = np.minimum.accumulate(y, axis=1)
    # leftmost place of the running minimum from the left
    new = np.ones_like(y, bool)
    new[:, 1:] = y[:, 1:] < fwd[:, :-1]
    fi = np.maximum.accumulate(np.where(new, idx, 0), axis=1)
    rev = y[:, ::-1]
    bwd = np.minimum.accumulate(rev, axis=1)
    new = np.ones_like(y, bool)
    new[:, 1:] = rev[:, 1:] <= bwd[:, :-1]  # equal and further left wins
    bi = np.minimum.accumulate(np.where(new, idx[:, ::-1], n + pad), axis=1)[:, ::-1].reshape(-1)
    fi = fi.reshape(-1)
    left, right = bi[:m], fi[w - 1 : n]
    return np.where(x[left] <= x[right], left, right)


def anchors(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(text, anchor, first start, last start) of a block: which anchor stands for which strings."""
    n = len(data)
    starts_ok = np.diff(offs) >= length
    if not starts_ok.any():
        return None
    p, q = C.powers(n + 1)
    c = np.empty(n + 1, U64)
    c[0] = 0
    np.cumsum(_BYTE[data] * p[:n], out=c[1:])
    g = (c[gram:] - c[:-gram]) * q[: n - gram + 1]
    g = C.mix(g)
    w = length - gram + 1
    at = _window_min_first(g, w)  # for each start, also over text borders; those are dropped
    text = np.repeat(np.arange(len(offs) - 1), np.maximum(0, np.diff(offs) - length + 1))
    first = np.concatenate([[0], np.cumsum(np.maximum(0, np.diff(offs) - length + 1))])[:-1]
    start = np.arange(len(text)) - first[text] + offs[text]
    at = at[start]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    k = np.flatnonzero(new)
    lo, hi = start[k], start[np.append(k[1:], len(start)) - 1]
    return text[k], at[k], lo, hi


def half_anchors(data: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(text, anchor, first start, last start, key hash, context hash, side) of a block.

    The strings of an anchor are parted by their distance d to it: up to `mid` they all
    hold the bytes [a, a + length - mid), beyond it all hold [a - mid - 1, a + gram). That
    common part is the key, so that a short common phrase alone brings no texts together.
    """
    found = anchors(data, offs, length, gram)
    if found is None:
        return None
    text, a, lo, hi = found
    mid = (length - gram) // 2
    near, far = a - hi <= mid, a - lo > mid
    side = np.repeat(np.array([0, 1], np.int8), [near.sum(), far.sum()])
    text, at = np.concatenate([text[near], text[far]]), np.concatenate([a[near], a[far]])
    lo2 = np.concatenate([np.maximum(lo, a - mid)[near], lo[far]])
    hi2 = np.concatenate([hi[near], np.minimum(hi, a - mid - 1)[far]])
    n = len(data)
    p, q = C.powers(n + 1)
    c = np.empty(n + 1, U64)
    c[0] = 0
    np.cumsum(_BYTE[data] * p[:n], out=c[1:])
    ks = np.where(side == 0, at, at - mid - 1)
    ke = np.where(side == 0, at + length - mid, at + gram)
    key = C.mix((c[ke] - c[ks]) * q[ks] ^ side.astype(np.uint64))
    ctx = C.mix(C.mix((c[hi2 + length] - c[lo2]) * q[lo2]) ^ ((at - lo2).astype(np.uint64) * U64(4099) + (hi2 - at + length).astype(np.uint64) * U64(1000003)))
    return text, at, lo2, hi2, key, ctx, side


def _key_map(length: int, gram: int, buckets: int):
    """Keys of each task, each at most twice, as packed arrays by range."""

    def run(batches):
        held, size = [], 0

        def pack():
            e = np.sort(np.concatenate(held))
            third = np.zeros(len(e), bool)
            third[2:] = e[2:] == e[:-2]
            return C.bucket_blobs(e[~third], buckets)

        for batch in batches:
            for _, _, data, offs in C.utf8_blocks(batch.column(0)):
                found = half_anchors(data, offs, length, gram)
                if found is None:
                    continue
                held.append(found[4])
                size += len(found[4])
                if size > 3_000_000:
                    yield pack()
                    held, size = [], 0
        if held:
            yield pack()

    return run


def _anchor_map(seen_b, length: int, gram: int):
    """Places of the keys that occur twice somewhere."""

    def run(batches):
        seen = np.frombuffer(seen_b.value, np.uint8)
        for batch in batches:
            ids, fps = batch.column(1), batch.column(2)
            for first, _, data, offs in C.utf8_blocks(batch.column(0)):
                found = half_anchors(data, offs, length, gram)
                if found is None:
                    continue
                k = np.flatnonzero(C.bit(seen, found[4], C.SEEN_BITS))
                text, a, lo, hi, key, ctx, side = (x[k] for x in found)
                take, base = pa.array(text + first), offs[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.as_long(key)), pa.array(C.as_long(ctx)), pa.array(side), ids.take(take), fps.take(take)] + [pa.array((x - base).astype(np.int32)) for x in (a, lo, hi)],
                    ["key", "ctx", "side", "doc_id", "fp", "at", "lo", "hi"],
                )

    return run


def _context_map(length: int, gram: int):
    """The suffixes to sort: the bytes of each wanted context from its key on, and those before it, backwards."""
    mid = (length - gram) // 2

    def run(batches):
        for batch in batches:
            texts, wants = batch.column(0).cast(pa.large_binary()), batch.column(1)
            cols: list[list] = [[] for _ in range(4)]
            for t, want in zip(texts, wants):
                raw = t.as_py()
                for x in want.as_py():
                    start = x["at"] - mid - 1 if x["side"] else x["at"]
                    for col, v in zip(cols, (x["key"], x["ctx"], raw[start : x["hi"] + length], raw[x["lo"] : start][::-1])):
                        col.append(v)
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["key", "ctx", "suffix", "before"])

    return run


def multikey_sort(tokens: np.ndarray) -> np.ndarray:
    """Order of the rows of an (n, k) array of tokens: sorts by the first token, then each run of equal rows by the next one."""
    n, k = tokens.shape
    order = np.argsort(tokens[:, 0], kind="quicksort")
    run = np.zeros(n, np.int64)  # number of the run of equal prefixes at each place of the order
    for j in range(k):
        if j:
            same = np.zeros(n, bool)
            same[1:] = run[1:] == run[:-1]
            same[:-1] |= same[1:]
            open_ = np.flatnonzero(same)
            if not len(open_):
                break
            part = order[open_]
            o = np.lexsort((tokens[part, j], run[open_]))
            order[open_] = part[o]
        t = tokens[order, j]
        step = np.ones(n, np.int64)
        step[1:] = (run[1:] != run[:-1]) | (t[1:] != t[:-1])
        run = np.cumsum(step)
    return order


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Rows of bytes, padded with zeros to a width of whole tokens."""
    wide = -(-max(1, width) // 8) * 8
    return np.frombuffer(b"".join(b.ljust(wide, b"\0") for b in blobs), np.uint8).reshape(len(blobs), wide)


def _sorted_runs(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' order, and how many leading bytes each one there has in common with the one before (none: -1)."""
    order = multikey_sort(rows.view(">u8").astype(np.uint64))
    t = rows[order]
    common = np.full(len(rows), -1, np.int64)
    differ = t[1:] != t[:-1]
    common[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, common


def bucket_repeats(suffixes: list[bytes], before: list[bytes], length: int):
    """Of the suffixes of a bucket (and the bytes before each, backwards): (row, d) of the strings that start d bytes
    before and that another row holds too, and (row, d, twice) of those of runs that touch an end of the bucket, one row of each string."""
    n = len(suffixes)
    size, pre = np.array([len(x) for x in suffixes]), np.array([len(x) for x in before])
    order, common = _sorted_runs(_matrix(suffixes, length))
    back_order, back_common = _sorted_runs(_matrix(before, int(pre.max())))
    back_place = np.empty(n, np.int64)
    back_place[back_order] = np.arange(n)
    back_place = back_place[order]  # from here on, rows in the order of the suffixes
    least, most = (length - size)[order], pre[order]  # a context's strings start at `least`..`most` bytes before
    found, ends = [], []
    for d in range(int(least.min()), int(most.max()) + 1):
        new = common < length - d
        new[0] = True
        run = np.cumsum(new)
        have = (least <= d) & (d <= most)
        edge = (run == 1) | (run == run[-1])
        many = ~new
        many[:-1] |= ~new[1:]  # runs of two rows or more
        rows = np.flatnonzero(have & (many | edge))
        if not len(rows):
            continue
        back = np.cumsum(back_common < d)
        code = run[rows] * (n + 1) + back[back_place[rows]]
        o = np.argsort(code, kind="stable")
        same = code[o][1:] == code[o][:-1]
        twice = np.zeros(len(rows), bool)
        twice[o[1:]] |= same
        twice[o[:-1]] |= same
        found.append((order[rows[twice]], np.full(int(twice.sum()), d)))
        first = np.ones(len(rows), bool)
        first[o[1:]] = ~same
        out = np.flatnonzero(edge[rows] & first)
        ends.append((order[rows[out]], np.full(len(out), d), twice[out]))
    join = lambda parts, k: tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * k
    return join(found, 2), join(ends, 3)


def _spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Covered ranges of strings that start at sorted places."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(x[0]), int(x[-1]) + length) for x in np.split(starts, cut)]


def _hashes(raw: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of one length that begin at the given places."""
    p, q = C.powers(len(raw) + 1)
    c = np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE[raw] * p[: len(raw)])])
    return C.mix((c[start + length] - c[start]) * q[start])


def _compare(length: int):
    """Sorts a bucket. Rows with spans are repeats within it; rows with strings are for the comparison across buckets: up to
    `step` neighbouring strings of a suffix, and the hash of what all of them hold, without which none can be equal to another's."""
    names = ["key", "ctx", "rel", "part", "common", "strings"]
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    string = pa.list_(pa.struct([("h", pa.int64()), ("s", pa.int32()), ("twice", pa.bool_())]))
    step = max(1, min(16, length // 4))

    def run(batches):
        from pyspark import TaskContext

        held: list[list] = [[], [], [], []]
        for batch in batches:
            for col, x in zip(held, batch.columns):
                col += x.to_pylist()
        key, ctx, suffixes, before = held
        if not key:
            return
        (row, d), (e_row, e_d, twice) = bucket_repeats(suffixes, before, length)
        pre = np.array([len(x) for x in before])
        start = pre[row] - d
        o = np.lexsort((start, row))
        row, start = row[o], start[o]
        cut = np.flatnonzero(np.diff(row, prepend=-1))
        rel = [[{"s": a, "e": z} for a, z in _spans(part, length)] for part in np.split(start, cut[1:])] if len(row) else []
        who = row[cut]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[i] for i in who], pa.int64()), pa.array([ctx[i] for i in who], pa.int64()), pa.array(rel, span), pa.nulls(len(who), pa.int32()), pa.nulls(len(who), pa.int64()), pa.nulls(len(who), string)], names
        )
        o = np.lexsort((e_d, e_row))
        e_row, e_d, twice = e_row[o], e_d[o], twice[o]
        rows: list[list] = [[], [], [], []]

        def out():
            keys, ctxs, common, strings = rows
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(ctxs, pa.int64()), pa.nulls(len(keys), span), pa.array([TaskContext.get().partitionId()] * len(keys), pa.int32()), pa.array(common, pa.int64()), pa.array(strings, string)], names
            )

        for at in np.split(np.arange(len(e_row)), np.flatnonzero(np.diff(e_row, prepend=-1))[1:]) if len(e_row) else ():  # the strings of one suffix
            i = int(e_row[at[0]])
            raw = np.frombuffer(before[i][::-1] + suffixes[i], np.uint8)
            s = pre[i] - e_d[at]
            h = C.as_long(_hashes(raw, s, length))
            first = e_d[at] // step * step
            heads = np.flatnonzero(np.diff(first, prepend=-1))
            common = C.as_long(_hashes(raw, pre[i] - first[heads], length - step + 1))
            for g, z in zip(np.split(np.arange(len(at)), heads[1:]), common.tolist()):
                for col, v in zip(rows, (key[i], ctx[i], z, [{"h": int(h[j]), "s": int(s[j]), "twice": bool(twice[at[j]])} for j in g])):
                    col.append(v)
            if len(rows[0]) > 20_000:
                yield out()
                rows = [[], [], [], []]
        yield out()

    return run


def _cut(with_text: bool):
    def run(batches):
        for batch in batches:
            ids, texts, spans = batch.column(0), batch.column(1).cast(pa.large_binary()), batch.column(2).to_pylist()
            n, gone, runs, sha, kept_text = [], [], [], [], []
            for t, sp in zip(texts, spans):
                raw = t.as_py() or b""
                n.append(len(raw))
                merged: list[list[int]] = []
                for s, e in sorted((x["s"], x["e"]) for x in sp or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                if merged:
                    edges = [0, *(x for m in merged for x in m), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
                else:
                    kept = raw
                gone.append(len(raw) - len(kept))
                runs.append(len(merged))
                sha.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept)
            cols = [ids, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols.append(pa.array(kept_text, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def suffix_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM, with_text: bool = False, bucket: int = BUCKET) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept bytes).

    A byte goes if a string of `length` bytes that covers it starts anywhere else too,
    the same text included. Null texts count as empty; rows that repeat an id and text are
    repeats of each other. Texts shorter than `length` stay whole. An empty table gives no rows; columns of other names play no part.
    """
    spark = docs.sparkSession
    gram = min(gram, length)
    texts = docs.select(F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"), docs[key].cast("long").alias("doc_id")).withColumn("fp", F.xxhash64("text"))
    long_enough = texts.where(F.octet_length("text") >= length)
    buckets = C.bucket_count(spark)
    seen, _ = C.class_bitmaps(long_enough.select("text").mapInArrow(_key_map(length, gram, buckets), "bucket int, blob binary"), buckets)
    seen = spark.sparkContext.broadcast(seen)
    found = long_enough.mapInArrow(_anchor_map(seen, length, gram), "key long, ctx long, side byte, doc_id long, fp long, at int, lo int, hi int")
    found = C.materialize(found, "anchors")
    per_ctx = found.groupBy("key", "ctx").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "fp", "at", "lo", "hi", "side")).alias("one"))
    per_key = found.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1")).where("n > 1")
    shared = per_ctx.join(per_key, "key").selectExpr("key", "ctx", "c", "c0 <> c1 AS mixed", "one")
    shared = C.materialize(shared, "shared")
    # one representative of each context of keys with several contexts
    want = shared.where("mixed").select("key", "ctx", "one.*")
    want = C.materialize(want.groupBy(F.col("doc_id").alias("d"), F.col("fp").alias("f")).agg(F.collect_list(F.struct("key", "ctx", "side", "at", "lo", "hi")).alias("wants")), "wants")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("fp") == F.col("f"))
    held = C.among(long_enough, want.select(F.col("d").alias("doc_id"), F.col("f").alias("fp"))).where("maybe").join(want, same).select("text", "wants")  # rows that repeat a text bring a context twice: harmless, it counts as whole
    suffixes = C.materialize(held.mapInArrow(_context_map(length, gram), "key long, ctx long, suffix binary, before binary"), "suffixes")
    parts = max(C.shuffle_partitions(spark), -(-suffixes.count() // bucket))
    ranged = suffixes.repartitionByRange(parts, "suffix", "before").select("key", "ctx", "suffix", "before")
    some = C.materialize(ranged.mapInArrow(_compare(length), "key long, ctx long, rel array<struct<s:int,e:int>>, part int, common long, strings array<struct<h:long,s:int,twice:boolean>>"), "compared")
    # strings of runs that reach over an end of a bucket, if another bucket has what they hold in common; one row for each bucket and string
    ends = some.where("rel is null")
    held = ends.groupBy(F.col("common").alias("g")).agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("g")
    ends = C.materialize(ends.join(held, F.col("common") == F.col("g")).select("key", "ctx", F.explode("strings").alias("x")).select("key", "ctx", "x.h", "x.s", "x.twice"), "ends")
    again = ends.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("n")).where("n > 1").select("g")
    over = ends.where("not twice").join(again, F.col("h") == F.col("g")).groupBy("key", "ctx").agg(F.collect_list(F.struct(F.col("s"), (F.col("s") + length).alias("e"))).alias("rel"))
    # contexts that occur twice repeat as a whole; of the others what a comparison found
    whole = shared.where("c > 1").select("key", "ctx", F.lit(None).cast("array<struct<s:int,e:int>>").alias("rel"))
    some = some.where("rel is not null").select("key", "ctx", "rel").unionByName(over).join(shared.where("c > 1").select("key", "ctx"), ["key", "ctx"], "left_anti")
    hits = C.materialize(whole.unionByName(some), "hits")
    rel = F.when(F.col("rel").isNull(), F.array(F.struct(F.col("lo").alias("s"), (F.col("hi") + length).alias("e")))).otherwise(
        F.transform("rel", lambda x: F.struct((x["s"] + F.col("lo")).alias("s"), (x["e"] + F.col("lo")).alias("e")))
    )
    spans = found.join(hits, ["key", "ctx"]).select(F.col("doc_id").alias("d"), F.col("fp").alias("f"), rel.alias("x"))
    spans = C.materialize(spans.groupBy("d", "f").agg(F.flatten(F.collect_list("x")).alias("spans")), "spans")
    # only texts that lose something are shuffled
    marked = C.among(texts, spans.select(F.col("d").alias("doc_id"), F.col("f").alias("fp")))
    some_texts = marked.where("maybe").join(spans, same, "left").select("doc_id", "text", "spans")
    others = marked.where("not maybe").select("doc_id", "text", F.lit(None).cast("array<struct<s:int,e:int>>").alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return others.unionByName(some_texts).mapInArrow(_cut(with_text), schema)


def op10_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op10_suffix_array_dedup": op10_suffix_array_dedup}
#: Bytes as pairs of hex digits; texts in parts of 4000 bytes and what follows, as places far into a string are slow to reach.
SQL = {
    "op10_suffix_array_dedup": """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS MATERIALIZED (SELECT doc_id, k, substr(h, 8000 * k + 1, 8400) AS part, len(h) // 2 AS n FROM (SELECT doc_id, h, unnest(range(0, len(h) // 8000 + 1)) AS k FROM d)),
b AS MATERIALIZED (SELECT doc_id, 4000 * k + j AS i, n, substr(part, 2 * j + 1, 2) AS x, CASE WHEN 4000 * k + j + 200 <= n THEN md5(substr(part, 2 * j + 1, 400)) END AS m FROM (SELECT doc_id, k, n, part, unnest(range(0, least(4000, n - 4000 * k))) AS j FROM c)),
r AS (SELECT m FROM b WHERE m IS NOT NULL GROUP BY m HAVING count(*) > 1),
g AS (SELECT b.doc_id, b.i, b.x, coalesce(max(CASE WHEN r.m IS NOT NULL THEN b.i END) OVER (PARTITION BY b.doc_id ORDER BY b.i) > b.i - 200, false) AS gone FROM b LEFT JOIN r ON r.m = b.m),
e AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT before) AS n_spans, string_agg(x, '' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM (SELECT *, lag(gone, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(e.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(e.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(e.kept, ''))) AS kept_sha256 FROM d LEFT JOIN e ON e.doc_id = d.doc_id
"""
}
