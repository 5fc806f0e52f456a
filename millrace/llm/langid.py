"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays.

Characters are the code points of letter runs, lower-cased, with a boundary mark around each run. For every language one model of
order ``ORDER``: the highest order from counts, lower ones from continuation counts (in
how many contexts a gram occurs), each interpolated with the next by absolute discounting.
All languages share one sorted array of 64-bit gram hashes per order, with one column of
probabilities for each language (a language that lacks the gram holds its interpolated
value), and one of back-off weights by context. A text gets the language of the lowest
cross-entropy per character. A fifth of the training texts (by hash) is kept from the counts and
calibrates: the margin to the second language gives the score; texts whose best cross-entropy lies
beyond that of nearly all these are flagged as rejected (column `rejected`), and texts without a
letter are `und`.

Training reads labelled rows only, about TRAIN_BYTES bytes of a language: whole texts, taken by
hash at a rate that follows from the language's total, the first in the order of hashes always. The
model's size is so bounded, and it is the only thing that is sent to all tasks. Words are
scored once per task, and grams once per set of words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

U64 = C.U64
ORDER = 5
TRAIN_BYTES = 4_000_000
DISCOUNT = 0.75
_MULT = U64(0x9E3779B97F4A7C15)
_STEP = 0xD6E8FEB86659FD93


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: whether it is no letter, its lower case (where that is one code point), and a hash of this."""
    every = [chr(i) for i in range(0x110000)]
    low = np.arange(0x110000, dtype=np.uint32)
    letter = np.array([c.isalpha() for c in every])
    for i in np.flatnonzero(letter):
        x = every[i].lower()
        if len(x) == 1:
            low[i] = ord(x)
    return ~letter, low, C.mix(low.astype(np.uint64) * _MULT + U64(31))


def code_points(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of UTF-8 texts, and the offsets of the texts among them."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    b = np.concatenate([data, np.zeros(3, np.uint8)])
    c = b[at].astype(np.uint32)
    for lead, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        k = np.flatnonzero(b[at] >= lead)
        x = b[at[k]].astype(np.uint32) & mask
        for j in range(1, more + 1):
            x = x << 6 | (b[at[k] + j].astype(np.uint32) & 0x3F)
        c[k] = x
    return np.minimum(c, 0x10FFFF), np.searchsorted(at, offs)


def word_chars(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' letters in lower case, each word with a mark (0) before and after, and the place where each begins."""
    n = ends - starts
    at = np.cumsum(n + 2) - (n + 2)
    out = np.zeros(int((n + 2).sum()), np.uint32)
    src = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    dst = np.repeat(at + 1 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    out[dst] = tables()[1][chars[src]]
    return out, at


def gram_hashes(chars: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """hashes[n-1][i]: hash of the n characters that end at i, cut at the word's first mark."""
    place = np.arange(len(chars)) - np.repeat(at, np.diff(np.append(at, len(chars))))
    c = chars.astype(np.uint64) + U64(1)
    out = [c.copy()]
    for n in range(2, order + 1):
        prev = out[-1]
        h = prev.copy()
        ok = place >= n - 1
        back = c[np.maximum(np.arange(len(c)) - (n - 1), 0)]
        h[ok] = prev[ok] + back[ok] * U64(pow(_STEP, n - 1, 1 << 64))
        out.append(h)  # near the word's start the longest gram there is
    return [C.mix(h * _MULT) for h in out]


class Model:
    """Sorted arrays of each order: hashes, log probabilities per language; contexts with back-off weights."""

    def __init__(self, langs: list[str], order: int):
        self.langs, self.order = langs, order
        self.grams: list[np.ndarray] = []
        self.probs: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.weights: list[np.ndarray] = []
        self.scale, self.limit = 1.0, np.full(len(langs), np.inf)

    @staticmethod
    def _find(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(keys, h)
        k[k == len(keys)] = 0
        return k, keys[k] == h

    def log_probs(self, hs: list[np.ndarray], ctx: list[np.ndarray], upto: int) -> np.ndarray:
        """Log probability of each gram under each language; hs and ctx by order."""
        k, ok = self._find(self.grams[0], hs[0])
        p = np.where(ok[:, None], self.probs[0][k], self.floor)
        for n in range(2, upto + 1):
            k, ok = self._find(self.contexts[n - 1], ctx[n - 1])
            p = p + np.where(ok[:, None], self.weights[n - 1][k], 0)
            k, ok = self._find(self.grams[n - 1], hs[n - 1])
            p = np.where(ok[:, None], self.probs[n - 1][k], p)
        return p

    def train(self, chars: list[np.ndarray], ats: list[np.ndarray], counts: list[np.ndarray]) -> None:
        """chars, ats: the distinct words of each language as by word_chars; counts: how often each occurs."""
        alphabet = 256 + 2 * len(np.unique(np.concatenate(chars))) if chars else 256
        per = []
        for ch, at, cnt in zip(chars, ats, counts):
            reps = np.diff(np.append(at, len(ch)))
            weight = np.repeat(cnt, reps)
            place = np.arange(len(ch)) - np.repeat(at, reps)
            hs = gram_hashes(ch, at, self.order)
            per.append((ch, weight, place, hs))
        self.floor = np.full(len(self.langs), np.log(1e-7))
        stats: list[list[tuple]] = []
        for _, weight, place, hs in per:
            mine = []
            for n in range(1, self.order + 1):
                ok = place >= max(1, n - 1)
                first = np.flatnonzero(ok)
                g, one, inv = np.unique(hs[n - 1][first], return_index=True, return_inverse=True)
                at_ = first[one]
                if n == self.order:
                    c = np.bincount(inv, weight[first], len(g))
                else:
                    # continuation: distinct grams of order n + 1 that end in this one; at a word's start, plain counts
                    c = np.bincount(inv, np.where(place[first] == n - 1, weight[first], 0), len(g))
                    longer = np.flatnonzero(place >= n)
                    pair = np.unique(np.stack([hs[n][longer], hs[n - 1][longer]]), axis=1) if len(longer) else np.zeros((2, 0), U64)
                    c = c + np.bincount(np.searchsorted(g, pair[1]), minlength=len(g))
                ctx = hs[n - 2][np.maximum(at_ - 1, 0)] if n > 1 else np.zeros(len(g), U64)
                mine.append((g, c, ctx, [h[at_] for h in hs[:n]], [h[np.maximum(at_ - 1, 0)] for h in hs[: n - 1]]))
            stats.append(mine)
        for n in range(1, self.order + 1):
            keys = np.unique(np.concatenate([s[n - 1][0] for s in stats]))
            ctxs = np.unique(np.concatenate([s[n - 1][2] for s in stats]))
            own, weights = [], np.zeros((len(ctxs), len(self.langs)), np.float32)
            lower_h = [np.zeros(len(keys), U64) for _ in range(n)]
            lower_c = [np.zeros(len(keys), U64) for _ in range(n)]
            own_ctx = np.zeros(len(keys), U64)
            for i, s in enumerate(stats):
                g, c, ctx, low, lowc = s[n - 1]
                x = np.searchsorted(ctxs, ctx)
                total = np.bincount(x, c, len(ctxs))
                kinds = np.bincount(x, minlength=len(ctxs))
                has = total > 0
                weights[has, i] = np.log(np.maximum(DISCOUNT * kinds[has] / total[has], 1e-9))
                k = np.searchsorted(keys, g)
                part = np.zeros(len(keys))
                part[k] = np.maximum(c - DISCOUNT, 0) / np.maximum(total[x], 1e-9)
                own.append(part)
                own_ctx[k] = ctx
                for j in range(n):
                    lower_h[j][k] = low[j]
                for j in range(n - 1):
                    lower_c[j + 1][k] = lowc[j]
            if n == 1:
                own = np.stack(own, 1)
                left = np.exp(weights[0])
                probs = np.log(own + left / alphabet)
                self.floor = np.log(left / alphabet)
            else:
                lower = self.log_probs(lower_h, lower_c, n - 1)
                probs = np.log(np.stack(own, 1) + np.exp(lower + weights[np.searchsorted(ctxs, own_ctx)]))
            self.grams.append(keys)
            self.probs.append(probs.astype(np.float32))
            self.contexts.append(ctxs)
            self.weights.append(weights)

    def word_scores(self, chars: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log probability of each word (its letters and closing mark) under each language."""
        hs = gram_hashes(chars, at, self.order)
        place = np.arange(len(chars)) - np.repeat(at, np.diff(np.append(at, len(chars))))
        # a gram is told by its longest form and, near a word's start, by its place
        tag = C.mix(hs[-1] ^ np.minimum(place, self.order - 1).astype(np.uint64))
        _, one, inv = np.unique(tag, return_index=True, return_inverse=True)
        before = np.maximum(one - 1, 0)
        p = np.zeros((len(one), len(self.langs)))
        for n in range(1, self.order + 1):
            # grams near the start go up to the order that fits there
            mine = np.flatnonzero(np.minimum(place[one] + 1, self.order) == n)
            if len(mine) and n > 1:
                o, b = one[mine], before[mine]
                p[mine] = self.log_probs([h[o] for h in hs], [np.zeros(len(o), U64), *[h[b] for h in hs]], n)
        out = p[inv]
        return np.add.reduceat(out, at, axis=0) if len(at) else np.zeros((0, len(self.langs)))


def _order() -> F.Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30))


def _lang_totals(docs: DataFrame) -> list[tuple[str, int, int]]:
    """(language, bytes, first of its rows in the order of hashes), a row per language."""
    rows = docs.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("n"), F.min(_order()).alias("low")).collect()
    return sorted((r["lang"], int(r["n"] or 0), r["low"]) for r in rows)


def _words_of(data: np.ndarray, offs: np.ndarray):
    """(code points, hash, start, end and text of each word, first word of each text) of a block."""
    chars, at = code_points(data, offs)
    no_letter, _, by_char = tables()
    h, s, e, first = C.words(chars, at, no_letter, by_char)
    return chars, h, s, e, np.repeat(np.arange(len(offs) - 1), np.diff(first)), first


def _words_map(batches):
    """(lang, word, count) of each task, combined within its batches; words as 32-bit code points."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for lo, hi, data, offs in C.utf8_blocks(batch.column(0)):
            chars, h, s, e, text, _ = _words_of(data, offs)
            if not len(h):
                continue
            names = sorted(set(langs[lo:hi]))
            code = np.array([names.index(x) for x in langs[lo:hi]])[text]
            tag = C.mix(h ^ C.mix(code.astype(np.uint64) + U64(1)))
            _, one, cnt = np.unique(tag, return_index=True, return_counts=True)
            words, at = word_chars(chars, s[one], e[one])
            raw, ends = words.tobytes(), np.append(at[1:], len(words))
            yield pa.RecordBatch.from_arrays([pa.array([names[c] for c in code[one]]), pa.array([raw[4 * a + 4 : 4 * b - 4] for a, b in zip(at.tolist(), ends.tolist())], pa.binary()), pa.array(cnt.astype(np.int64))], ["lang", "word", "c"])


def train(docs: DataFrame, order: int = ORDER, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """The models from rows (text, lang, doc_id); rows without a language or a text do not count."""
    docs = docs.where("lang is not null and text is not null")
    totals = _lang_totals(docs)
    if not totals:
        return None
    pick = F.lit(False)
    for lang, n, low in totals:
        rate = min(1.0, train_bytes / max(1, n))
        pick = pick | ((F.col("lang") == lang) & (_order() <= max(low, int(rate * (1 << 30)))))
    inner = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(5)) == 0  # kept from the counts
    sample = C.materialize(docs.where(pick).select("text", "lang", inner.alias("inner")), "langsample")
    langs = [x for x, *_ in totals]
    counted = sample.where("not inner")
    lacking = set(langs) - {r["lang"] for r in counted.select("lang").distinct().collect()}
    if lacking:  # languages of so few texts that none is left for the counts
        counted = sample.where(~F.col("inner") | F.col("lang").isin(*lacking))
    words = counted.select("text", "lang").mapInArrow(_words_map, "lang string, word binary, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))
    table = words.toArrow()  # bounded by train_bytes for each language
    lang = np.array(table["lang"].to_pylist(), object)
    word, cnt = table["word"].to_pylist(), np.array(table["c"].to_pylist(), float)
    chars, ats, counts = [], [], []
    for name in langs:
        mine = sorted((word[i], cnt[i]) for i in np.flatnonzero(lang == name))
        n = np.array([len(w) // 4 for w, _ in mine], np.int64)
        s = np.cumsum(n) - n
        ch, at = word_chars(np.frombuffer(b"".join(w for w, _ in mine), np.uint32), s, s + n) if len(n) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        chars.append(ch)
        ats.append(at)
        counts.append(np.array([c for _, c in mine]))
    model = Model(langs, order)
    model.train(chars, ats, counts)
    # calibration on texts that the counts have not seen: scale of the margin, and the range of good cross-entropies
    spark = docs.sparkSession
    held = sample.where("inner")
    fit = C.materialize(held.select("text", "lang").mapInArrow(_score_map(spark.sparkContext.broadcast(model), True), "lang string, best int, h array<float>, n long").where("n > 0"), "langfit")
    for r in fit.groupBy("best").agg(F.percentile_approx(F.expr("h[best]"), 0.999, 1000).alias("q")).collect():
        model.limit[r["best"]] = r["q"] + 0.5
    if len(langs) > 1:
        right = F.element_at(F.array(*[F.lit(x) for x in langs]), F.col("best") + 1) == F.col("lang")
        margin = fit.select(F.expr("n * (array_sort(h)[1] - array_sort(h)[0])").alias("m"), right.alias("ok"))
        wrong = margin.agg(F.avg(F.when(~F.col("ok"), F.col("m"))).alias("bad"), F.expr("percentile_approx(m, 0.1)").alias("low")).first()
        # the margin at which the odds are even-handed: errors have small margins
        model.scale = 1.0 / max(1e-6, wrong["bad"] if wrong["bad"] else (wrong["low"] or 1.0) / 10)
    return model


def _score_map(model_b, fit: bool = False):
    def run(batches):
        model: Model = model_b.value
        k = len(model.langs)
        memo = C.Memo(k)
        for batch in batches:
            extra = batch.column(1)
            for lo, hi, data, offs in C.utf8_blocks(batch.column(0)):
                chars, h, s, e, text, first = _words_of(data, offs)
                total, n = np.zeros((hi - lo, k)), np.zeros(hi - lo)
                if len(h):
                    keys, one, inv = np.unique(h, return_index=True, return_inverse=True)
                    score = memo.get(keys, lambda new: model.word_scores(*word_chars(chars, s[one[new]], e[one[new]])))
                    for j in range(k):
                        total[:, j] = np.bincount(text, score[inv, j], hi - lo)
                    n = np.bincount(text, (e - s) + 1, hi - lo).astype(float)
                ent = -total / np.maximum(n, 1)[:, None]
                best = ent.argmin(1)
                if fit:
                    yield pa.RecordBatch.from_arrays([extra.slice(lo, hi - lo), pa.array(best.astype(np.int32)), pa.array([x.astype(np.float32) for x in ent], pa.list_(pa.float32())), pa.array(n.astype(np.int64))], ["lang", "best", "h", "n"])
                    continue
                low = ent.min(1)
                gap = np.clip((ent - low[:, None]) * n[:, None] * model.scale, 0, 50)
                conf = 1 / np.exp(-gap).sum(1)
                letters = np.diff(first) > 0
                pred = [model.langs[b] if ok else "und" for b, ok in zip(best, letters)]
                yield pa.RecordBatch.from_arrays(
                    [extra.slice(lo, hi - lo), pa.array(pred), pa.array(np.where(letters, conf, 0.0)), pa.array(np.where(letters, low, 0.0)), pa.array(~letters | (low > model.limit[best]))],
                    ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"],
                )

    return run


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected; `und` for texts that are null or have no letter, or without a model."""
    rows = docs.select(docs["text"].cast("string").alias("text"), docs["doc_id"].cast("long").alias("doc_id"))
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("cross_entropy"), F.lit(True).alias("rejected"))
    out = rows.mapInArrow(_score_map(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")
    return out


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op9_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


QUERIES = {"op9_language_id": op9_language_id}
