"""Embedding near-dedup on a robust-pruned flat graph.

1. Equal vectors are merged into classes, named by a hash of their components; the rest works
   on distinct unit vectors.
2. k-means on a bounded sample (``SAMPLE`` vectors by hash, ``SHARDS`` centroids at most) gives
   one centroid for each ``SHARD`` vectors. A vector x is dealt to its nearest centroid h and to
   every shard d with x.h - x.d <= s / 2 * chord * |h - d|, where chord is the distance of unit
   vectors at the threshold. Two linked vectors x and y with homes h and d have
   (x.h - x.d) + (y.d - y.h) = (x - y).(h - d) <= chord * |h - d|, so with s = 1 one of them
   is in the other's home. As a deviation in n dimensions points along one line by 1 / sqrt(n) of
   its length, s = SIGMAS / sqrt(n) (1 at most) is taken. The number of shards of a vector
   follows from the threshold and not from the number of vectors.
3. Each shard is a task that builds a graph by insertion: each batch of vectors searches the graph
   so far from the medoid, what it visits is robust-pruned (an edge is left out if a kept neighbour
   is ALPHA times closer to its end), and reverse edges are added, pruned too where a list is full. A
   vector's lists of all its shards are united into one flat graph.
4. Each vector is a query in each of its shards: greedy search with a beam from the medoid and its
   own list, where every vector within the range is expanded too, so that dense groups are walked whole.
5. Found pairs are verified by exact cosines in double precision, and counted in the first
   shard that holds both. A task returns a count and a local representative for each query, not its pairs.
6. `audit` measures the recall of the result against all vectors by brute force for
   ``AUDIT`` queries; below ``RECALL`` the search is done again with twice the overlap.

A shard of more than ``SPLIT`` vectors (a dense group that centroids cannot part) is dealt into
blocks by hash, each with a graph of its own, and the shard's queries run against every block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

THRESHOLD = 0.95
SAMPLE = 20_000
SHARDS = 16_384
SHARD = 2000
SPLIT = 16_000
SIGMAS = 3.0
DEGREE = 24
ALPHA = 1.2
BUILD_BEAM, BEAM = 32, 16
BATCH = 512
AUDIT = 512
RECALL = 0.9


# ---------------------------------------------------------------- graph
def robust_prune(x: np.ndarray, sims: np.ndarray, cand: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """For each row, up to `degree` of its candidates (by falling similarity, -1 pads), none of
    which is alpha times closer to an earlier kept one than to the row's vector."""
    n, k = cand.shape
    dist = np.where(cand >= 0, np.maximum(2 - 2 * sims, 0), np.inf)
    vec = x[np.maximum(cand, 0)]
    between = np.maximum(2 - 2 * np.matmul(vec, vec.transpose(0, 2, 1)), 0)
    keep = np.full((n, degree), -1, np.int64)
    count = np.zeros(n, np.int64)
    alive = cand >= 0
    for j in range(k):
        r = np.flatnonzero(alive[:, j] & (count < degree))
        if not len(r):
            continue
        keep[r, count[r]] = cand[r, j]
        count[r] += 1
        alive[r] &= alpha * alpha * between[r, j] > dist[r]
    return keep


def _fresh(nodes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Rows of nodes (-1 pads) without repeats in a row and without those seen, which all are from now on."""
    nodes = np.sort(nodes, axis=1)
    rows = np.arange(len(nodes))[:, None]
    old = seen[rows, np.maximum(nodes, 0)] | (nodes < 0)
    old[:, 1:] |= nodes[:, 1:] == nodes[:, :-1]
    nodes = np.where(old, -1, nodes)
    r, c = np.nonzero(nodes >= 0)
    seen[r, nodes[r, c]] = True
    return nodes


def _scored(x: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    s = np.matmul(x[np.maximum(nodes, 0)], queries[:, :, None])[:, :, 0]
    s[nodes < 0] = -3
    return s


def beam_search(x: np.ndarray, adj: np.ndarray, queries: np.ndarray, start: np.ndarray, seen: np.ndarray, beam: int, hit: float = 3.0, width: int = 4):
    """Greedy search of all queries at once over lists adj (-1 pads). (beam's vectors, their
    similarities, queries and vectors of all that was seen with a similarity >= hit)."""
    got_q, got_v = [], []

    def look(nodes):
        nodes = _fresh(nodes, seen)
        s = _scored(x, queries[rows], nodes) if len(rows) < len(queries) else _scored(x, queries, nodes)
        if hit <= 1:
            r, c = np.nonzero(s >= hit)
            got_q.append(rows[r])
            got_v.append(nodes[r, c])
        return nodes, s

    rows = np.arange(len(queries))
    best = np.full((len(queries), beam), -1, np.int64)
    sim = np.full((len(queries), beam), -3.0, np.float32)
    open_ = np.zeros((len(queries), beam), bool)
    all_seen = seen
    nodes, s = look(start)
    while True:
        both_s = np.concatenate([sim[rows], s], 1)
        o = np.argpartition(-both_s, beam - 1, axis=1)[:, :beam]
        both_s = np.take_along_axis(both_s, o, 1)
        o2 = np.argsort(-both_s, axis=1, kind="stable")
        o = np.take_along_axis(o, o2, 1)
        sim[rows] = np.take_along_axis(both_s, o2, 1)
        best[rows] = np.take_along_axis(np.concatenate([best[rows], nodes], 1), o, 1)
        open_[rows] = np.take_along_axis(np.concatenate([open_[rows], nodes >= 0], 1), o, 1)
        rows = np.flatnonzero(open_.any(1))
        if not len(rows):
            break
        # the closest open ones of each beam
        rank = np.cumsum(open_[rows], axis=1)
        take = open_[rows] & (rank <= width)
        chosen = np.full((len(rows), width), -1, np.int64)
        r, c = np.nonzero(take)
        chosen[r, rank[r, c] - 1] = best[rows[r], c]
        open_[rows] &= ~take
        ends = np.where(chosen[:, :, None] >= 0, adj[np.maximum(chosen, 0)], -1).reshape(len(rows), -1)
        seen = all_seen[rows]
        nodes, s = look(ends)
        all_seen[rows] = seen
    join = lambda a: np.concatenate(a) if a else np.zeros(0, np.int64)
    return best, sim, join(got_q), join(got_v)


def _add_reverse(x: np.ndarray, adj: np.ndarray, src: np.ndarray, dst: np.ndarray) -> None:
    """Edges dst -> src into the lists of dst; where they do not fit, the list is pruned anew."""
    o = np.lexsort((src, dst))
    src, dst = src[o], dst[o]
    head = np.flatnonzero(np.concatenate([[True], dst[1:] != dst[:-1]]))
    place = np.arange(len(dst)) - np.repeat(head, np.diff(np.append(head, len(dst))))
    nodes = dst[head]
    have = (adj[nodes] >= 0).sum(1)
    spot = place + np.repeat(have, np.diff(np.append(head, len(dst))))
    fits = spot < adj.shape[1]
    adj[dst[fits], spot[fits]] = src[fits]
    full = np.flatnonzero(np.bincount(np.searchsorted(nodes, dst[~fits]), minlength=len(nodes)))
    for part in np.array_split(full, 1 + len(full) // 256):
        if not len(part):
            continue
        mine = np.isin(dst, nodes[part]) & ~fits
        row, col = np.searchsorted(nodes[part], dst[mine]), place[mine]
        extra = np.full((len(part), int(col.max()) + 1), -1, np.int64)
        extra[row, col] = src[mine]
        # at most twice the degree, the closest: a hub of a batch gets the others from their own lists
        cand = np.concatenate([adj[nodes[part]], extra], 1)
        s = _scored(x, x[nodes[part]], cand)
        k = min(cand.shape[1], 2 * adj.shape[1])
        order = np.argsort(-s, axis=1, kind="stable")[:, :k]
        adj[nodes[part]] = robust_prune(x, np.take_along_axis(s, order, 1), np.take_along_axis(cand, order, 1), adj.shape[1])


def build(x: np.ndarray, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) of the vectors of one shard. Besides the pruned lists, each vector and the
    nearest that it found are joined both ways, so that groups hold together."""
    n = len(x)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = x.astype(np.float32)
    medoid = int((x @ x.mean(0)).argmax())
    order = np.random.Generator(np.random.PCG64(n)).permutation(n)
    order = np.concatenate([[medoid], order[order != medoid]])
    adj = np.full((n, degree), -1, np.int64)
    nearest = np.full(n, -1, np.int64)
    done = 1
    while done < n:
        batch = order[done : done + min(BATCH, max(32, done))]
        start = np.full((len(batch), 1), medoid)
        best, sim, _, _ = beam_search(x, adj, x[batch], start, np.zeros((len(batch), n), bool), BUILD_BEAM)
        # those that are inserted together do not see each other in the graph
        mates = x[batch] @ x[batch].T
        np.fill_diagonal(mates, -3)
        k = min(8, len(batch))
        near = np.argpartition(-mates, k - 1, axis=1)[:, :k]
        near_s = np.take_along_axis(mates, near, 1)
        cand, s = np.concatenate([best, np.where(near_s > -3, batch[near], -1)], 1), np.concatenate([sim, near_s], 1)
        o = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, o, 1), np.take_along_axis(s, o, 1)
        lists = robust_prune(x, s, cand, degree)
        adj[batch] = lists
        nearest[batch] = lists[:, 0]
        src = np.repeat(batch, degree)
        dst = lists.reshape(-1)
        _add_reverse(x, adj, src[dst >= 0], dst[dst >= 0])
        done += len(batch)
    src, dst = np.repeat(np.arange(n), degree), adj.reshape(-1)
    src, dst = src[dst >= 0], dst[dst >= 0]
    child = np.flatnonzero(nearest >= 0)
    return np.concatenate([src, child, nearest[child]]), np.concatenate([dst, nearest[child], child])


def lists_of(src: np.ndarray, dst: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges as rows: (first edge of each vector and the total, ends)."""
    code = np.unique(src * n + dst) if n else np.zeros(0, np.int64)
    return np.searchsorted(code, np.arange(n + 1) * n), code % max(1, n)


def neighbours(graph: tuple[np.ndarray, np.ndarray], rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, neighbour) for each neighbour of each node."""
    first, ends = graph
    n = first[nodes + 1] - first[nodes]
    at = np.repeat(first[nodes] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(rows, n), ends[at]


def padded(graph: tuple[np.ndarray, np.ndarray], rows: np.ndarray, width: int) -> np.ndarray:
    """The first `width` neighbours of each row, -1 pads."""
    first, ends = graph
    at = first[rows][:, None] + np.arange(width)
    inside = at < first[rows + 1][:, None]
    return np.where(inside, ends[np.minimum(at, max(0, len(ends) - 1))] if len(ends) else -1, -1)


def range_search(x: np.ndarray, graph, queries: np.ndarray, start: np.ndarray, threshold: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs with similarity >= threshold that a range-expanding greedy search finds; all queries at once."""
    n = len(x)
    seen = np.zeros((len(queries), n), bool)
    first, _ = graph
    adj = padded(graph, np.arange(n), int(min(2 * DEGREE, max(1, np.diff(first).max()))))
    _, _, q, v = beam_search(x, adj, queries, start, seen, beam, threshold)
    got_q, got_v = [q], [v]
    while len(q):  # every vector within the range is expanded once for each query
        new_q, new_v = [], []
        for k in range(0, len(q), 20_000):
            rows, nodes = neighbours(graph, q[k : k + 20_000], v[k : k + 20_000])
            fresh = ~seen[rows, nodes]
            code = np.unique(rows[fresh] * n + nodes[fresh])
            rows, nodes = code // n, code % n
            seen[rows, nodes] = True
            for part in np.array_split(np.arange(len(rows)), 1 + len(rows) // 100_000):
                near = np.einsum("nd,nd->n", queries[rows[part]], x[nodes[part]]) >= threshold
                new_q.append(rows[part][near])
                new_v.append(nodes[part][near])
        q, v = np.concatenate(new_q), np.concatenate(new_v)
        got_q.append(q)
        got_v.append(v)
    return np.concatenate(got_q), np.concatenate(got_v)


# ---------------------------------------------------------------- shards
def unit(rows) -> np.ndarray:
    """Unit vectors in double precision."""
    x = np.array(rows, float)
    top = np.abs(x).max(1, keepdims=True)
    x = x / top  # neither squares of large nor of tiny components leave the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; the first centroids lie evenly in a hash order of the sample."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(10 if k <= 512 else 2):
        near = np.concatenate([(part @ c.T).argmax(1) for part in np.array_split(x, 1 + len(x) // 2048)])
        for j in range(x.shape[1]):
            c[:, j] = np.bincount(near, x[:, j], k)
        size = np.bincount(near, minlength=k)
        lost = np.flatnonzero(size == 0)
        if len(lost):
            c[lost] = x[np.linspace(0, len(x) - 1, len(lost)).astype(int)]
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def _deal_map(centroids_b, threshold: float, sigmas: float):
    """Unit vectors as bytes, one row for each shard of a vector; all: its shards in order."""

    def run(batches):
        c = centroids_b.value
        reach = (np.sqrt(2 - 2 * threshold) + 1e-9) * min(1.0, sigmas / np.sqrt(c.shape[1])) / 2
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, len(batch), 1024)):
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                x = unit(flat.reshape(len(part), -1))
                dot = x @ c.T
                home = dot.argmax(1)
                row, col = np.nonzero(dot.max(1, keepdims=True) - dot <= 2 * reach)
                near = dot[row, home[row]] - dot[row, col] <= reach * np.linalg.norm(c[home[row]] - c[col], axis=1)
                row, col = row[near], col[near].astype(np.int32)
                raw = x.tobytes()
                step = 8 * x.shape[1]
                first = np.searchsorted(row, np.arange(len(part) + 1))
                shards = [col[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col), part.column(0).take(at), pa.array([raw[i * step : (i + 1) * step] for i in row.tolist()], pa.binary()), part.column(2).take(at), pa.array([shards[i] for i in row.tolist()], pa.binary())],
                    ["shard", "id", "v", "c", "shards"],
                )

    return run


def _vectors(column, o: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(o), -1)[o]


def _build_group(key, table):
    """Adjacency of a shard or block by ids: one row per vector."""
    ids = table["id"].to_numpy()
    o = np.argsort(ids, kind="stable")
    ids = ids[o]
    first, ends = lists_of(*build(_vectors(table["v"], o)), len(ids))
    return pa.table({"id": ids, "out": pa.array([ids[ends[a:b]].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())})


def _first_common(shards: np.ndarray, a: np.ndarray, b: np.ndarray, here: int) -> np.ndarray:
    """Whether no shard before `here` holds both vectors; shards: each vector's shards, -1 pads."""
    out = np.ones(len(a), bool)
    for part in np.array_split(np.arange(len(a)), 1 + len(a) // 100_000):
        x, y = shards[a[part]], shards[b[part]]
        both = ((x[:, :, None] == y[:, None, :]) & (x >= 0)[:, :, None]).any(2)
        out[part] = ~(both & (x < here)).any(1)
    return out


def _search_group(threshold: float):
    def run(key, table):
        here = int(key[0].as_py())
        ids = table["id"].to_numpy()
        o = np.argsort(ids, kind="stable")
        ids = ids[o]
        x = _vectors(table["v"], o)
        asks, held, weight = (table[n].to_numpy()[o] for n in ("asks", "data", "c"))
        data, ask = np.flatnonzero(held), np.flatnonzero(asks)
        total, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        if not len(data) or not len(ask):
            return pa.table({"id": ids[ask], "n": total[ask], "root": ids[ask]})
        mine = [np.frombuffer(b, np.int32) for b in table["shards"].to_pylist()]
        shards = np.full((len(ids), max(map(len, mine))), -1, np.int32)
        for i, j in enumerate(o):
            shards[i, : len(mine[j])] = mine[j]
        lists = [np.frombuffer(b"".join(b), np.int64) for b in table["out"].to_pylist()]
        flat = np.concatenate([lists[i] for i in o])
        owner = np.repeat(np.arange(len(ids)), [len(lists[i]) for i in o])
        known = ids[data]
        at = np.searchsorted(known, flat)
        at[at == len(known)] = 0
        inside = known[at] == flat  # neighbours in other shards are reached there
        owner, at = owner[inside], at[inside]
        code = np.unique(owner * len(data) + at)
        own = (np.searchsorted(code, np.arange(len(ids) + 1) * len(data)), code % len(data))  # entry points of each query
        spot = np.full(len(ids), -1, np.int64)
        spot[data] = np.arange(len(data))
        inner = spot[owner] >= 0
        graph = lists_of(spot[owner[inner]], at[inner], len(data))
        y = x[data].astype(np.float32)
        medoid = int((y @ y.mean(0)).argmax())
        step = max(64, min(1024, (64 << 20) // len(data)))
        for k in range(0, len(ask), step):
            part = ask[k : k + step]
            start = np.column_stack([np.full(len(part), medoid), padded(own, part, 2 * DEGREE)])
            q, v = range_search(y, graph, x[part].astype(np.float32), start, threshold - 1e-5)
            a, b = part[q], data[v]
            ok = ids[a] != ids[b]
            for i in range(0, len(a), 100_000):
                s = slice(i, i + 100_000)
                ok[s] &= np.einsum("nd,nd->n", x[a[s]], x[b[s]]) >= threshold
            a, b = a[ok], b[ok]
            first = _first_common(shards, a, b, here)
            total += np.bincount(a[first], weight[b[first]], len(ids)).astype(np.int64)
            while True:  # smallest places reachable by the links so far
                low = root.copy()
                np.minimum.at(low, a, root[b])
                np.minimum.at(low, b, root[a])
                np.minimum.at(low, root, low.copy())
                low = low[low]
                if (low == root).all():
                    break
                root = low
        return pa.table({"id": ids[ask], "n": total[ask], "root": ids[root[ask]]})

    return run


def search_links(vectors: DataFrame, threshold: float = THRESHOLD, sigmas: float = SIGMAS) -> DataFrame:
    """(id, n, root) of distinct vectors (id, v, c copies): for each query and shard, the copies it links with and a vector it is linked to by some path."""
    spark = vectors.sparkSession
    n = vectors.count()
    rate = min(1.0, SAMPLE / max(1, n))
    part = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= int(rate * (1 << 30))).orderBy(F.xxhash64("id"), "id").select("v").collect()
    sample = unit([r["v"] for r in part]) if part else np.zeros((0, 1))
    k = max(1, min(len(sample), SHARDS, -(-n // SHARD)))
    centroids = spark.sparkContext.broadcast(kmeans(sample, k) if len(sample) else np.zeros((1, 1)))
    dealt = C.materialize(vectors.select("id", "v", "c").mapInArrow(_deal_map(centroids, threshold, sigmas), "shard int, id long, v binary, c long, shards binary"), "shards")
    sizes = dealt.groupBy("shard").agg(F.count("*").alias("size")).where(F.col("size") > SPLIT).select(F.col("shard").alias("s"), F.ceil(F.col("size") / SPLIT).cast("int").alias("b"))
    dealt = dealt.join(sizes, F.col("shard") == F.col("s"), "left").withColumn("blocks", F.coalesce("b", F.lit(1)))
    dealt = dealt.select("shard", "id", "v", "c", "shards", "blocks", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks").cast("long")).cast("int").alias("block"))
    built = dealt.groupBy("shard", "block").applyInArrow(_build_group, "id long, out binary")
    flat = C.materialize(built.groupBy("id").agg(F.collect_list("out").alias("out")), "graph").select(F.col("id").alias("i"), "out")
    # a task: the vectors of one block, and one slice of the shard's queries
    each = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = dealt.join(flat, F.col("id") == F.col("i"))
    cols = ["id", "v", "c", "shards", "out"]
    data = dealt.select("shard", "block", F.explode(each).alias("slice"), *cols, F.lit(True).alias("data"), (F.col("slice") == F.col("block")).alias("asks"))
    asks = dealt.where("blocks > 1").select("shard", F.explode(each).alias("b"), F.col("block").alias("slice"), "block", *cols).where("b <> block")
    asks = asks.select("shard", F.col("b").alias("block"), "slice", *cols, F.lit(False).alias("data"), F.lit(True).alias("asks"))
    return data.unionByName(asks).groupBy("shard", "block", "slice").applyInArrow(_search_group(threshold), "id long, n long, root long")


def valid(v: F.Column) -> F.Column:
    """No null, no null or non-finite component, not all zero."""
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda e: e != 0)


def near_dedup(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept, recall (as audited), one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing. Vectors of different lengths never link. Copies count as links of each other, and
    rows that repeat an id are vectors of their own. A null id never names a component and is
    never kept; other columns of the input play no part.
    """
    rows = embeddings.select(embeddings[key].cast("long").alias("vec_id"), embeddings[vector].cast("array<double>").alias("v"))
    good = rows.where(valid(F.col("v"))).select("vec_id", "v", F.xxhash64("v").alias("id"))
    classes = C.materialize(good.groupBy("id").agg(F.min("vec_id").alias("low"), F.count("*").alias("c"), F.first("v").alias("v")), "vectors")
    sizes = [r["n"] for r in classes.groupBy(F.size("v").alias("n")).agg(F.count("*")).collect()]
    sigmas = SIGMAS
    while True:
        found = None
        for n in sizes or [0]:
            some = search_links(classes.where(F.size("v") == n).select("id", "v", "c"), threshold, sigmas)
            found = some if found is None else found.unionByName(some)
        found = C.materialize(found, "found")
        degree = found.groupBy(F.col("id").alias("a")).agg(F.sum("n").alias("deg"))
        recall = min([audit(classes.where(F.size("v") == n), degree, threshold) for n in sizes] or [1.0])
        if recall >= RECALL or sigmas >= max(sizes) ** 0.5:  # from there on every link has a common shard
            break
        sigmas *= 2
    comps = C.materialize(C.connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "cc5"), "comps")
    named = classes.join(degree, F.col("id") == F.col("a"), "left").join(comps, F.col("id") == F.col("node"), "left")
    named = C.materialize(named.select("id", "low", (F.coalesce("deg", F.lit(0)) + F.col("c") - 1).alias("n_links"), F.coalesce("comp", "id").alias("comp")), "named")
    # components of several classes have a name to find; a class alone has its own
    several = named.groupBy("comp").agg(F.min("low").alias("lowest"), F.count("*").alias("k")).where("k > 1").select(F.col("comp").alias("p"), "lowest", "k")
    named = named.join(several, F.col("comp") == F.col("p"), "left").select(F.col("id").alias("k"), "n_links", F.when(F.col("p").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component"))
    keyed = rows.select("vec_id", F.when(valid(F.col("v")), F.xxhash64("v")).alias("id"))
    out = keyed.join(named, F.col("id") == F.col("k"), "left")
    component = F.when(F.col("k").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(float(recall)).alias("recall"))


def audit(classes: DataFrame, degree: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT) -> float:
    """Recall of links: degree (a, deg) against all vectors of one length (id, v, c) by brute force, for a hash sample of queries."""
    spark = classes.sparkSession
    asked = classes.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(queries).select("id", "v").collect()
    if not asked:
        return 1.0
    sent = spark.sparkContext.broadcast((np.array([r["id"] for r in asked]), unit([r["v"] for r in asked])))

    def count(batches):
        ids, q = sent.value
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            if not len(batch):
                continue
            hit = (unit(flat.reshape(len(batch), -1)) @ q.T >= threshold) & (batch.column(0).to_numpy()[:, None] != ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array((hit * batch.column(2).to_numpy()[:, None]).sum(0))], ["q", "n"])

    true = classes.select("id", "v", "c").mapInArrow(count, "q long, n long").groupBy("q").agg(F.sum("n").alias("n")).where("n > 0")
    both = true.join(degree, F.col("q") == F.col("a"), "left").agg(F.sum("n").alias("n"), F.sum(F.least("n", F.coalesce("deg", F.lit(0)))).alias("found")).first()
    return 1.0 if not both["n"] else both["found"] / both["n"]


def op5_embedding_dedup(spark, sf_dir):
    return near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op5_embedding_dedup": op5_embedding_dedup}
SQL = {
    "op5_embedding_dedup": """
WITH RECURSIVE g AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
v AS MATERIALIZED (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM g),
e AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.n > 0 AND b.n > 0 AND list_inner_product(a.v, b.v) / (a.n * b.n) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
d AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT m.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, coalesce(c.component_id, m.vec_id) AS component_id, m.vec_id = coalesce(c.component_id, m.vec_id) AS kept, CAST(1 AS DOUBLE) AS recall
FROM embeddings m LEFT JOIN c ON c.x = m.vec_id LEFT JOIN d ON d.x = m.vec_id
"""
}
