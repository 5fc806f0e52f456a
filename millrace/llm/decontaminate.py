"""Benchmark decontamination: n-gram seeds, then Smith-Waterman on words.

Words are lower-cased and parted at white space, as 64-bit hashes. Every n-gram that a
document shares with an item is a seed, however many documents hold it: a count cannot
tell a common phrase from a leak with many copies. Around each cluster of seeds of an item
the item is aligned with the document's words (match +2, mismatch -1, gap -1, affine-free
Smith-Waterman, many windows at once); pairs whose best local score reaches ``MIN_SCORE``
of the item's own are kept. Windows take half an item's length on both sides, so that edits
and insertions fit. A window is aligned only if twice the words it has in common with the
item, which no alignment exceeds, reach that score; chance hits of common phrases end there.

Nothing is shuffled but results, and the documents are read once for each block. The
benchmark is the side that is sent to all tasks; it is taken in blocks of at most
``BLOCK_WORDS`` words, so that what is sent has a fixed bound however long the benchmark is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

U64 = C.U64
GRAM = 3
MIN_SCORE = 0.5
BLOCK_WORDS = 2_000_000
CELLS = 1 << 22  # of windows that are aligned at once
_COEF = np.random.Generator(np.random.PCG64(9)).integers(1, 2**63, 8, dtype=np.uint64) | U64(1)


def _grams(h: np.ndarray, n: int) -> np.ndarray:
    m = len(h) - n + 1
    if m <= 0:
        return h[:0]
    s = h[:m] * _COEF[0]
    for j in range(1, n):
        s += h[j : j + m] * _COEF[j]
    return C.mix(s)


class Items:
    """A block of benchmark items: word hashes, and its grams sorted, with the items and places that hold them."""

    def __init__(self, ids: list[int], texts: list[str], gram: int):
        self.ids, self.gram = np.array(ids, np.int64), gram
        self.words = []
        for _, _, data, offs in C.utf8_blocks(pa.array(texts, pa.string())):
            h, _, _, first = C.words(data, offs)
            self.words += [h[a:b] for a, b in zip(first[:-1], first[1:])]
        g, item, place = [], [], []
        for i, w in enumerate(self.words):
            n = min(gram, len(w))  # an item shorter than a gram is one gram
            v = _grams(w, n) if n else w
            g.append(v)
            item.append(np.full(len(v), i))
            place.append(np.arange(len(v)))
        g, item, place = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((g, U64), (item, np.int64), (place, np.int64)))
        o = np.argsort(g, kind="stable")
        self.g, self.item, self.place = g[o], item[o], place[o]
        self.sizes = sorted({min(gram, len(w)) for w in self.words} - {0})
        self.keys = np.unique(self.g)
        # each item's different words and how often it has them, as sorted keys of both
        self.own, self.times = np.unique(self.word_keys(np.concatenate([*self.words, self.g[:0]]), np.repeat(np.arange(len(self.words)), [len(w) for w in self.words])), return_counts=True)
        self.mask = np.zeros(1 << 20, bool)
        self.mask[(self.keys >> U64(44)).astype(np.int64)] = True

    @staticmethod
    def word_keys(h: np.ndarray, item: np.ndarray) -> np.ndarray:
        return C.mix(h ^ C.mix(item.astype(U64) + U64(1)))

    def common(self, h: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray) -> np.ndarray:
        """For each window of h, the number of words it has in common with its item, repeats counted as often as both have them."""
        out = np.zeros(len(lo), np.int64)
        step = np.cumsum(hi - lo) // CELLS
        for part in np.split(np.arange(len(lo)), np.flatnonzero(np.diff(step)) + 1):
            n = hi[part] - lo[part]
            win = np.repeat(np.arange(len(part)), n)
            at = np.arange(len(win)) - np.repeat(np.cumsum(n) - n, n) + lo[part][win]
            v = self.word_keys(h[at], item[part][win])
            k = np.searchsorted(self.own, v)
            k[k == len(self.own)] = 0
            same = self.own[k] == v
            pair, c = np.unique(win[same] * len(self.own) + k[same], return_counts=True)
            out[part] = np.bincount(pair // len(self.own), np.minimum(c, self.times[pair % len(self.own)]), len(part))
        return out

    def hits(self, h: np.ndarray, first: np.ndarray):
        """(place in h, number of the key) of the grams of a block's texts that the items hold."""
        found = []
        for n in self.sizes:
            v = _grams(h, n)
            at = np.flatnonzero(self.mask[(v >> U64(44)).astype(np.int64)])
            k = np.searchsorted(self.keys, v[at])
            k[k == len(self.keys)] = 0
            same = self.keys[k] == v[at] if len(self.keys) else np.zeros(0, bool)
            at, k = at[same], k[same]
            text = np.searchsorted(first, at, "right") - 1
            inside = at + n <= first[text + 1]  # a gram never crosses a border
            found.append((at[inside], k[inside], text[inside]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def smith_waterman(a: np.ndarray, wins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of words a against each row of wins (0 pads), and the column where it ends."""
    m = len(wins)
    prev = np.zeros((m, wins.shape[1] + 1), np.int32)
    best, end = np.zeros(m, np.int32), np.zeros(m, np.int64)
    ramp = np.arange(wins.shape[1] + 1, dtype=np.int32)
    for x in a:
        score = np.where(wins == x, np.int32(2), np.int32(-1))
        cur = np.zeros_like(prev)
        np.maximum(prev[:, :-1] + score, prev[:, 1:] - 1, out=cur[:, 1:])
        np.maximum(cur, 0, out=cur)
        # gaps along the row: running maximum of value + column, less the column
        np.maximum.accumulate(cur + ramp, axis=1, out=cur)
        cur -= ramp
        top = cur.max(1)
        better = top > best
        if better.any():
            best = np.where(better, top, best)
            end = np.where(better, cur.argmax(1), end)
        prev = cur
    return best, end


def _aligned(items: Items, lo_of: np.ndarray, hi_of: np.ndarray, column: pa.Array, min_score: float) -> list[tuple[int, int, float, int, int]]:
    """(row, item, score, seeds, end word) of the windows that reach min_score."""
    rows: list[tuple] = []
    for base, _, data, offs in C.utf8_blocks(column):
        h, _, _, first = C.words(data, offs)
        at, k, text = items.hits(h, first)
        # every (item, place) that holds the gram
        n = hi_of[k] - lo_of[k]
        rep = np.repeat(np.arange(len(at)), n)
        e = lo_of[k][rep] + np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n)
        if not len(e):
            continue
        item, start, doc = items.item[e], at[rep] - items.place[e], text[rep]
        o = np.lexsort((start, item, doc))
        item, start, doc = item[o], start[o], doc[o]
        size = np.array([len(w) for w in items.words])[item]
        # hits whose diagonals lie within half an item belong to one window
        new = np.ones(len(o), bool)
        new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] - start[:-1] > size[1:] // 2)
        cut = np.flatnonzero(new)
        last = np.append(cut[1:], len(o)) - 1
        w_item, w_doc, seeds = item[cut], doc[cut], last - cut + 1
        half = size[cut] // 2 + 1
        w_lo = np.maximum(start[cut] - half, first[w_doc])
        w_hi = np.minimum(start[last] + size[cut] + half, first[w_doc + 1])
        # an alignment scores at most 2 for each word in common
        able = items.common(h, w_lo, w_hi, w_item) >= min_score * size[cut]
        for it in np.unique(w_item[able]):
            mine = np.flatnonzero(able & (w_item == it))
            mine = mine[np.argsort(w_hi[mine] - w_lo[mine])]
            # of widths within a power of two, so that padding at most doubles a part
            wide = w_hi[mine] - w_lo[mine]
            step = np.cumsum(wide) // CELLS + (np.frexp(wide)[1].astype(np.int64) << 40)
            for part in np.split(mine, np.flatnonzero(np.diff(step)) + 1):
                width = int((w_hi[part] - w_lo[part]).max())
                wins = np.zeros((len(part), width), U64)
                for r, j in enumerate(part):
                    wins[r, : w_hi[j] - w_lo[j]] = h[w_lo[j] : w_hi[j]]
                score, end = smith_waterman(items.words[it], wins)
                share = score / (2.0 * len(items.words[it]))
                for r in np.flatnonzero(share >= min_score):
                    j = part[r]
                    rows.append((base + int(w_doc[j]), int(items.ids[it]), float(share[r]), int(seeds[j]), int(w_lo[j] + end[r] - first[w_doc[j]])))
    return rows


def _align_map(items_b, min_score: float):
    def run(batches):
        items = items_b.value
        lo_of, hi_of = np.searchsorted(items.g, items.keys), np.searchsorted(items.g, items.keys, "right")
        for batch in batches:
            rows = _aligned(items, lo_of, hi_of, batch.column(0), min_score)
            take = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).take(take), *(pa.array([r[c] for r in rows], t) for c, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()), (4, pa.int64())))],
                ["doc_id", "item_id", "score", "n_seeds", "end_word"],
            )

    return run


def _keep_map(items_b, min_score: float, at: int):
    """Whole rows that hold no item."""

    def run(batches):
        items = items_b.value
        lo_of, hi_of = np.searchsorted(items.g, items.keys), np.searchsorted(items.g, items.keys, "right")
        for batch in batches:
            keep = np.ones(len(batch), bool)
            keep[[r[0] for r in _aligned(items, lo_of, hi_of, batch.column(at), min_score)]] = False
            yield batch.filter(pa.array(keep))

    return run


def item_blocks(docs: DataFrame, benchmark: DataFrame, gram: int):
    """The items of each block of the benchmark, sent to all tasks."""
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.size(F.split(F.col("text"), r"\s+")))).first()[0] or 0
    blocks = 1 + int(total // BLOCK_WORDS)
    for b in range(blocks):
        # at most about BLOCK_WORDS words come to the driver at a time
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        yield sc.broadcast(Items([r["item_id"] for r in part], [r["text"] for r in part], gram))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", gram: int = GRAM, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, n_seeds, end_word): each pair's best alignment that reaches min_score.

    score: best local score over twice the item's words; end_word: the word after the
    alignment. Null or empty texts and items match nothing; items that repeat count each;
    rows that repeat an id count as one document.
    """
    texts = docs.select(docs[text].cast("string").alias("text"), docs[key].cast("long").alias("doc_id")).where("text is not null")
    out = None
    for items_b in item_blocks(docs, benchmark, gram):
        got = texts.mapInArrow(_align_map(items_b, min_score), "doc_id long, item_id long, score double, n_seeds long, end_word long")
        out = got if out is None else out.unionByName(got)
    best = out.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", "n_seeds", "end_word")).alias("x"))
    return best.select("doc_id", "item_id", "x.score", "x.n_seeds", "x.end_word")


def decontaminate(docs: DataFrame, benchmark: DataFrame, gram: int = GRAM, min_score: float = MIN_SCORE) -> DataFrame:
    """docs without rows that hold a benchmark item; all columns pass through, nothing is shuffled."""
    at = [c.lower() for c in docs.columns].index("text")
    out = docs
    for items_b in item_blocks(docs, benchmark, gram):
        out = out.mapInArrow(_keep_map(items_b, min_score, at), docs.schema)
    return out


def op4_benchmark_decontamination(spark, sf_dir):
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op4_benchmark_decontamination": op4_benchmark_decontamination}
