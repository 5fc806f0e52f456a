"""Variable-capacity best-fit packing over the histogram of lengths.

Documents are sequences of tokens (in the query ids of a public vocabulary, by default UTF-8 bytes, the
ids of a byte-level one); those longer than the largest capacity give full sequences of that size and
a rest. The plan needs only how many pieces of each length there are: at most as many
numbers as the largest capacity, whatever the corpus. On the driver, lengths are placed
from the longest down into the open bin with the least room that fits (best fit; of these the
smallest), all equal pieces and equal bins at once. When none fits, a bin of the least-cost size is
opened. Which sizes may be opened is chosen jointly: each set of permitted sizes that
holds the largest is packed, bins are downsized to the smallest size that holds their
contents, and the cheapest plan wins. Cost of a sequence of size c: c * (1 + c / (4 * top))
+ 32, linear work, attention that grows with the square, and a fixed overhead.

A plan is a list of runs "pieces r..s of length l go into bins from b on, m to a bin, at
this offset". Pieces get their rank within a length without a window over it: pieces are
counted by (length, hash bucket of the row), running sums over the buckets of a length
give each bucket its first rank, and ranks are counted within (length, bucket), with more
buckets for lengths that many documents share.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import common as C
from millrace.llm.token_shards import token_lengths

SIZES = (512, 1024, 2048, 4096, 8192)


def cost(size: int, top: int) -> float:
    return size * (1 + size / (4 * top)) + 32


def size_to_open(length: int, left: int, sizes: tuple[int, ...]) -> int:
    """The size that costs least per token held: the equal pieces that go in, and three quarters of the room that shorter ones may fill."""

    def price(c: int) -> float:
        used = min(left, c // length) * length
        return cost(c, max(sizes)) / (used + 0.75 * (c - used))

    return min((c for c in sizes if c >= length), key=lambda c: (price(c), c))


def pack(hist: dict[int, int], sizes: tuple[int, ...]) -> tuple[list[tuple[int, int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Best fit decreasing of `hist` (length: pieces) into bins of `sizes`.

    Returns runs (length, first rank, pieces, first bin, pieces to a bin, offset in the bin)
    and bin ranges (first bin, bins, tokens in each).
    """
    # classes of equal bins: room -> list of (first bin, bins, filled, capacity)
    open_: dict[int, list[tuple[int, int, int, int]]] = {}
    rooms: list[int] = []
    runs, n_bins = [], 0

    def put(first: int, bins: int, filled: int, cap: int):
        room = cap - filled
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((first, bins, filled, cap))

    for length in sorted(hist, reverse=True):
        left, rank = hist[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                cap = size_to_open(length, left, sizes)
                m = cap // length
                bins = -(-left // m)
                put(n_bins, bins, 0, cap)
                n_bins += bins
                continue
            room = rooms[at]
            group = open_[room]  # of equal room, the smallest capacity
            first, bins, filled, cap = group.pop(min(range(len(group)), key=lambda i: group[i][3]))
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            m = room // length
            full = min(bins, left // m)
            if full:
                runs.append((length, rank, full * m, first, m, filled))
                put(first, full, filled + m * length, cap)
                rank, left = rank + full * m, left - full * m
            if full < bins:
                if left and left < m:
                    runs.append((length, rank, left, first + full, left, filled))
                    put(first + full, 1, filled + left * length, cap)
                    rank, left, full = rank + left, 0, full + 1
                if full < bins:
                    put(first + full, bins - full, filled, cap)
    ranges = sorted((first, bins, filled) for group in open_.values() for first, bins, filled, _ in group if filled)
    return runs, ranges


def downsize(tokens: int, sizes: tuple[int, ...]) -> int:
    return min(c for c in sizes if c >= tokens)


def plan_cost(ranges, sizes: tuple[int, ...]) -> float:
    return sum(bins * cost(downsize(filled, sizes), max(sizes)) for _, bins, filled in ranges)


def best_plan(hist: dict[int, int], sizes: tuple[int, ...]):
    """The cheapest plan over all sets of opening sizes that hold the largest one."""
    sizes = tuple(sorted(sizes))
    found = []
    for n in range(len(sizes)):
        for some in combinations(sizes[:-1], n):
            runs, ranges = pack(hist, (*some, sizes[-1]))
            found.append((plan_cost(ranges, sizes), n, some, runs, ranges))
    return min(found, key=lambda x: x[:3])


def piece_table(docs: DataFrame, key: str, length: F.Column, top: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens, row): the pieces of all rows; row tells rows of one id apart."""
    base = docs.select(docs[key].cast("long").alias("doc_id"), length.cast("long").alias("n"))
    base = base.where("n > 0")
    each = F.transform(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {top} as int)")), lambda i: F.struct(i.alias("piece"), (i * F.lit(top).cast("long")).alias("start")))
    return base.select("doc_id", "n", F.explode(each).alias("x")).select("doc_id", "x.piece", "x.start", F.least(F.lit(top).cast("long"), F.col("n") - F.col("x.start")).alias("n_tokens"))


def best_fit_packing(docs: DataFrame, length: F.Column | None = None, key: str = "doc_id", sizes: tuple[int, ...] = SIZES, rows_per_bucket: int = 4096) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin_id, offset, capacity), one row per piece.

    length: tokens of a row, by default the bytes of `text`. Null and empty texts have no
    piece. Rows that repeat an id give a piece each. Bins are numbered from 0 without gaps.
    """
    spark = docs.sparkSession
    top = max(sizes)
    length = F.octet_length(F.coalesce(docs["text"].cast("string"), F.lit(""))) if length is None else length
    pieces = C.materialize(piece_table(docs, key, length, top), "pieces")
    # the histogram has at most `top` rows
    hist = {r["n_tokens"]: r["c"] for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("c")).collect()}
    if not hist:
        return pieces.select("doc_id", "piece", "start", "n_tokens", F.lit(0).cast("long").alias("bin_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("capacity"))
    _, _, _, runs, ranges = best_plan(hist, sizes)
    # bins without gaps: unused ones only arise at the end of an opening run
    buckets = {n: C.pow2_at_least(1 + c // rows_per_bucket) for n, c in hist.items()}
    crowded = {n: b for n, b in buckets.items() if b > 1}
    nb = F.lit(1)
    if crowded:
        nb = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in crowded.items() for x in kv]), F.col("n_tokens").cast("int")), F.lit(1))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), nb.cast("long")))
    counts = pieces.groupBy("n_tokens", "bucket").agg(F.count("*").alias("c"))
    by_len = Window.partitionBy("n_tokens").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col("n_tokens").alias("l"), F.col("bucket").alias("k"), F.coalesce(F.sum("c").over(by_len), F.lit(0)).alias("base"))
    in_bucket = Window.partitionBy("n_tokens", "bucket").orderBy("doc_id", "piece")
    ranked = pieces.withColumn("r", F.row_number().over(in_bucket) - 1).join(firsts, (F.col("n_tokens") == F.col("l")) & (F.col("bucket") == F.col("k")))
    ranked = ranked.select("doc_id", "piece", "start", "n_tokens", (F.col("r") + F.col("base")).alias("rank"))
    by_length: dict[int, list] = {}
    for n, rank, count, first, m, filled in runs:
        by_length.setdefault(n, []).append((rank, count, first, m, filled))
    # bounded by the lengths and sizes, not by the corpus: safe to send to all tasks
    plan = spark.createDataFrame([(n, sorted(x)) for n, x in by_length.items()], "l long, runs array<struct<rank:long,n:long,first:long,m:long,filled:long>>")
    # runs of a length are in rank order: the last that starts at or before a rank holds it
    placed = ranked.join(F.broadcast(plan), F.col("n_tokens") == F.col("l")).withColumn("run", F.element_at(F.filter("runs", lambda x: x["rank"] <= F.col("rank")), -1))
    step = F.col("rank") - F.col("run.rank")
    bin_raw = F.col("run.first") + F.expr("(rank - run.rank) div run.m")
    offset = F.col("run.filled") + (step % F.col("run.m")) * F.col("n_tokens")
    # bin numbers without gaps and their downsized capacity, from the ranges of used bins
    shift, out, n = [], [], 0
    for first, bins, filled in ranges:
        out.append((first, bins, n, downsize(filled, tuple(sorted(sizes)))))
        n += bins
    starts = spark.createDataFrame(out, "first long, bins long, new long, capacity int")
    placed = placed.select("doc_id", "piece", "start", "n_tokens", bin_raw.alias("raw"), offset.alias("offset"))
    # a range join by blocks of bins: each range lists the blocks it touches
    block = max(1, n // 4096)
    starts = starts.select("*", F.explode(F.expr(f"sequence(first div {block}, (first + bins - 1) div {block})")).alias("blk"))
    both = placed.withColumn("blk", F.expr(f"raw div {block}")).join(F.broadcast(starts), "blk").where("raw >= first and raw < first + bins")
    return both.select("doc_id", "piece", "start", "n_tokens", (F.col("raw") - F.col("first") + F.col("new")).alias("bin_id"), "offset", "capacity")


def op2_best_fit_packing(spark, sf_dir):
    lengths = C.materialize(token_lengths(spark.read.parquet(f"{sf_dir}/documents.parquet")), "lengths")
    return best_fit_packing(lengths, F.col("n_tokens"))


QUERIES = {"op2_best_fit_packing": op2_best_fit_packing}
