"""Toxicity: a support vector machine on a gapped string-subsequence kernel with Nyström landmarks.

The kernel counts common subsequences of four letters (a word's beginning counts as one)
within a span of ``SPAN`` + 1 characters, each weighted by DECAY to the length of its span, so that strings with
inserted, masked or spaced-out characters stay close. Units of a sentence are its words;
runs of single letters make up one unit, long words are read in overlapping windows, and
digits and signs that stand for letters count as these. A sentence is as toxic as its
worst unit, a text as its worst sentence.

Training takes labelled rows only, at most ``TRAIN_DOCS`` of a label (by hash, whole
texts), and only their text. Landmarks are the units that tell toxic texts from others
best, and the most frequent other units. The kernel against the landmarks, whitened by
K(L, L) ** -1/2, gives the features of a linear squared-hinge machine, which is trained on
the witnesses: in each toxic text the unit that scores highest, three rounds, against the
units of other texts. As the machine is linear in the kernel's feature space, landmarks
and weights collapse into one table of the landmarks' subsequences; that table (some MB at
most) is what the tasks get, and scoring a unit takes a few look-ups a character. Logistic calibration
on the training texts' maxima and sums gives the score.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import common as C

U64 = C.U64
WIDE = 24
SPAN, DECAY = 5, 0.75
TRAIN_DOCS = 5000
LANDMARKS = 128
ROUNDS = 6
# Codes: 1-26 letters, 27 other letters, 28 other signs. Digits and signs that stand for letters.
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_CODE = np.full(256, 28, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
for _k, _v in _LEET.items():
    _CODE[ord(_k)] = ord(_v) - 96
_SOLID = np.zeros(256, bool)  # a unit ends with one of these
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True
_START, _END = 29, 30  # a word's beginning and end count as letters
_PATTERNS = [(a, b, d, DECAY ** (d + 1)) for a, b, d in combinations(range(1, SPAN + 1), 3)]


def units(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end, hash) of each unit of a block; the hash is 0 for units that are not plain words."""
    h, s, e, first = C.words(data, offs)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    n = e - s
    single = n == 1
    follows = np.zeros(len(n), bool)
    follows[1:] = single[1:] & single[:-1] & (text[1:] == text[:-1])
    heads = np.flatnonzero(~follows)
    last = np.append(heads[1:], len(n)) - 1
    text, s, e, h = text[heads], s[heads], e[last] if len(heads) else e, np.where(last > heads, U64(0), h[heads])
    wide = np.flatnonzero(e - s > WIDE)
    if len(wide):
        more = -(-(e[wide] - s[wide] - WIDE) // (WIDE // 2)) + 1
        k = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
        ws = np.repeat(s[wide], more) + k * (WIDE // 2)
        we = np.minimum(ws + WIDE, np.repeat(e[wide], more))
        keep = np.ones(len(s), bool)
        keep[wide] = False
        text, s, e, h = (np.concatenate([x[keep], y]) for x, y in ((text, np.repeat(text[wide], more)), (s, ws), (e, we), (h, np.zeros(len(ws), U64))))
    return text, s, e, h


def codes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Letter codes of units, padded with 0; signs at the end do not count."""
    at = s[:, None] + np.arange(WIDE)
    inside = at < e[:, None]
    raw = data[np.minimum(at, len(data) - 1)]
    solid = inside & _SOLID[raw]
    upto = WIDE - solid[:, ::-1].argmax(1)
    inside &= np.arange(WIDE) < np.where(solid.any(1), upto, 0)[:, None]
    out = np.zeros((len(s), WIDE + 2), np.uint8)
    out[:, 0] = _START
    code = np.where(inside, _CODE[raw], 0)
    signs = np.flatnonzero((code == 28).any(1))
    if len(signs):  # signs and spaces between letters are left out
        order = np.argsort((code[signs] == 28) | (code[signs] == 0), axis=1, kind="stable")
        code[signs] = np.take_along_axis(np.where(code[signs] == 28, 0, code[signs]), order, 1)
        inside = code > 0
    out[:, 1:-1] = code
    out[np.arange(len(s)), inside.sum(1) + 1] = _END
    return out


def _subsequences(c: np.ndarray):
    """(index of four letters or 0, weight, mask) for each pattern of gaps."""
    x = c.astype(np.int32)
    letter = (c > 0) & (c != 28)
    n = c.shape[1]
    for a, b, d, w in _PATTERNS:
        ok = letter[:, : n - d] & letter[:, a : n - d + a] & letter[:, b : n - d + b] & letter[:, d:]
        yield np.where(ok, (x[:, : n - d] << 15) | (x[:, a : n - d + a] << 10) | (x[:, b : n - d + b] << 5) | x[:, d:], 0), w, ok


def numbering(c: np.ndarray) -> np.ndarray:
    """Numbers 1.. for the subsequences that occur in c, 0 for all others."""
    used = np.unique(np.concatenate([idx[ok] for idx, _, ok in _subsequences(c)]))
    out = np.zeros(1 << 20, np.int32)
    out[used] = np.arange(1, len(used) + 1)
    return out


def features(c: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Dense kernel features of a few units, scaled."""
    out = np.zeros((len(c), number.max() + 1), np.float32)
    norm = np.zeros(len(c))
    rows = np.arange(len(c))[:, None]
    for idx, w, ok in _subsequences(c):
        np.add.at(out, (np.broadcast_to(rows, idx.shape), number[idx]), np.float32(w) * ok)
        norm += w * w * ok.sum(1)
    out[:, 0] = 0
    return out / np.sqrt(np.maximum(norm, 1e-12))[:, None].astype(np.float32)


def project(c: np.ndarray, number: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Scaled kernel products of units with each column of tables; row 0 of tables is zero."""
    out = np.zeros((len(c), tables.shape[1]))
    norm = np.zeros(len(c))
    for idx, w, ok in _subsequences(c):
        out += w * tables[number[idx]].sum(1)
        norm += w * w * ok.sum(1)
    return out / np.sqrt(np.maximum(norm, 1e-12))[:, None]


def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 2e-4, rounds: int = 25) -> np.ndarray:
    """Primal Newton steps of the L2 machine; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = y * (x @ w) < 1
        xs = x[on] * weight[on, None]
        new = np.linalg.solve(xs.T @ x[on] + ridge * weight.sum() * np.eye(len(w)), xs.T @ y[on])
        if np.allclose(new, w, atol=1e-7):
            break
        w = 0.5 * (w + new) if _ > 12 else new
    return w


def logistic(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic fit, the intercept last."""
    z = np.column_stack([z, np.ones(len(z))])
    a = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -30, 30)))
        g = z.T @ (weight * (y - p)) - 1e-2 * a
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(a))
        step = np.clip(np.linalg.solve(hess, g), -4, 4)
        a += step
        if np.abs(step).max() < 1e-8:
            break
    return a


def evidence(texts: int, text: np.ndarray, unit: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Per text: the highest margin of its units, and the log of what its distinct units have above 0."""
    best = np.full(texts, -2.0)
    np.maximum.at(best, text, f[unit])
    on = np.flatnonzero(f[unit] > 0)
    pair = np.unique(text[on].astype(np.int64) * (len(f) + 1) + unit[on])
    return np.column_stack([best, np.log1p(np.bincount(pair // (len(f) + 1), f[pair % (len(f) + 1)], texts))])


class Model:
    def __init__(self, number: np.ndarray, table: np.ndarray, bias: float, landmarks: list[bytes]):
        self.number, self.table, self.bias, self.landmarks = number, table, bias, landmarks
        self.scale = np.array([1.0, 0.0, 0.0])

    def margins(self, c: np.ndarray) -> np.ndarray:
        return np.clip(project(c, self.number, self.table)[:, 0] + self.bias, -2, 2)

    def scores(self, seen: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(seen @ self.scale[:-1] + self.scale[-1], -30, 30)))


def fit(docs: list[tuple[int, list[bytes]]], rates: dict[int, float]) -> Model | None:
    """A model from (label, distinct units) of texts; rates: the share of each label's texts that was taken."""
    units_ = pa.array([u for _, u in docs], pa.list_(pa.binary()))
    return fit_arrays(np.array([y for y, _ in docs], int), units_, rates)


def fit_arrays(label: np.ndarray, units_: pa.ListArray, rates: dict[int, float]) -> Model | None:
    """As fit, from arrays: no Python object for each unit of each text."""
    if not (label == 1).any() or not (label == 0).any():
        return None
    coded = units_.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.large_binary())
    by_name = pc.sort_indices(names)
    names = names.take(by_name)
    place = np.empty(len(names), np.int32)
    place[by_name.to_numpy()] = np.arange(len(names), dtype=np.int32)
    flat = place[coded.indices.to_numpy(zero_copy_only=False)]
    owner = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(units_.offsets.to_numpy()))
    df = np.stack([np.bincount(flat[label[owner] == y], minlength=len(names)) for y in (0, 1)])
    rate = df / np.array([[(label == 0).sum()], [(label == 1).sum()]])
    lift = np.log((rate[1] + 1e-3) / (rate[0] + 1e-3))
    start = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1)
    raw = np.frombuffer(names.buffers()[2], np.uint8)
    parts = [slice(i, i + 20000) for i in range(0, len(names), 20000)]
    c = np.concatenate([codes(raw, start[:-1][k], start[1:][k]) for k in parts])
    usable = np.concatenate([sum(ok.any(1) for _, _, ok in _subsequences(c[k])).astype(bool) for k in parts])
    telling = np.flatnonzero(usable & (df[1] >= 2) & (lift > 0))
    telling = telling[np.argsort(-(lift * np.sqrt(df[1]))[telling], kind="stable")][: 5 * LANDMARKS // 8]
    common = np.flatnonzero(usable & (df[0] >= df[1]))
    common = common[np.argsort(-df[0][common], kind="stable")]
    marks = np.concatenate([telling, common[: LANDMARKS - len(telling)]])
    if not len(marks):
        return None
    clean, tox = label[owner] == 0, label[owner] == 1
    score = np.where(df[1] >= 2, lift * np.sqrt(df[1]), lift - 10).astype(np.float32)
    score[~usable] = -np.inf
    hard = np.zeros(len(names))
    model = None
    for turn in range(ROUNDS):
        if turn in (0, 2, 4):  # the worst units of other texts become landmarks too
            worst = np.argsort(-hard, kind="stable")[: LANDMARKS // 2]
            marks = np.unique(np.concatenate([marks, worst[hard[worst] > 0]]))
            number = numbering(c[marks])
            phi = features(c[marks], number)
            val, vec = np.linalg.eigh((phi @ phi.T).astype(float))
            white = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-3))) @ vec.T
        # witnesses: the units of a toxic text that score at least half of its highest
        top = np.full(len(label), -np.inf)
        mine = score[flat]
        np.maximum.at(top, owner, mine)
        near = tox & (mine >= np.where(top > 0, 0.5 * top, top)[owner]) & np.isfinite(mine)
        per_text = np.bincount(owner[near], minlength=len(label))
        witness = np.bincount(flat[near], 1 / per_text[owner[near]], minlength=len(names))
        # other texts' worst units so far, and their most frequent ones
        if model is not None:
            worst = clean & (mine >= np.maximum(top, -0.5)[owner])
            hard += np.bincount(flat[worst], minlength=len(names))
        pos, neg = np.flatnonzero(witness), np.unique(np.concatenate([common[:4000], np.flatnonzero(hard)]))
        rows = np.concatenate([pos, neg])
        x = np.concatenate([project(part, number, phi.T) for part in np.array_split(c[rows], 1 + len(rows) // 400)]) @ white
        weight = np.concatenate([witness[pos] / witness[pos].sum(), 0.5 * np.log1p(df[0][neg]) / max(np.log1p(df[0][neg]).sum(), 1e-9) + 0.5 * hard[neg] / max(hard.sum(), 1e-9)])
        w = squared_hinge(x, np.concatenate([np.ones(len(pos)), -np.ones(len(neg))]), weight)
        table = (phi.T @ (white @ w[:-1]))[:, None]
        model = Model(number, table, float(w[-1]), [names[int(i)].as_py() for i in marks])
        f = np.concatenate([model.margins(part) for part in np.array_split(c, 1 + len(c) // 8000)])
        score = np.where(usable, f, -np.inf).astype(np.float32)
    weight = np.array([1 / max(rates.get(int(v), 1.0), 1e-9) for v in label])
    model.scale = logistic(evidence(len(label), owner, flat, f), label.astype(float), weight / weight.mean())
    model.scale[:2] = np.maximum(model.scale[:2], 0.01)
    return model


def _unit_map(batches):
    """(toxic, distinct units) of each text."""
    for batch in batches:
        label = batch.column(1)
        for lo, hi, data, offs in C.utf8_blocks(batch.column(0)):
            text, s, e, _ = units(data, offs)
            raw = data.tobytes().lower()
            out: list[set] = [set() for _ in range(hi - lo)]
            for t, a, b in zip(text.tolist(), s.tolist(), e.tolist()):
                out[t].add(raw[a:b])
            yield pa.RecordBatch.from_arrays([label.slice(lo, hi - lo), pa.array([sorted(x) for x in out], pa.list_(pa.binary()))], ["toxic", "units"])


def _scores(model: Model, column: pa.Array, memo: C.Memo) -> np.ndarray:
    out = []
    for lo, hi, data, offs in C.utf8_blocks(column):
        text, s, e, h = units(data, offs)
        inv, f = np.zeros(0, np.int64), np.zeros(0)
        if len(s):

            def margins(k):
                return np.concatenate([model.margins(codes(data, s[p], e[p])) for p in np.array_split(k, 1 + len(k) // 8000)])

            tag = np.where(h == 0, np.arange(1, len(h) + 1, dtype=np.uint64), h | U64(1 << 63))
            keys, one, inv = np.unique(tag, return_index=True, return_inverse=True)
            odd = int(np.searchsorted(keys, U64(1 << 63)))  # units of several words, or parts of long ones
            plain = memo.get(keys[odd:], lambda new: margins(one[odd:][new])[:, None])[:, 0]
            f = np.concatenate([margins(one[:odd]), plain]) if odd else plain
        out.append(model.scores(evidence(hi - lo, text, inv, f)))
    return np.concatenate(out) if out else np.zeros(0)


def _score_map(model_b):
    def run(batches):
        memo = C.Memo(1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(_scores(model_b.value, batch.column(0), memo))], ["doc_id", "score"])

    return run


def _keep_map(model_b, at: int, limit: float):
    """Whole rows whose text scores below the limit."""

    def run(batches):
        memo = C.Memo(1)
        for batch in batches:
            yield batch.filter(pa.array(_scores(model_b.value, batch.column(at), memo) < limit))

    return run


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that training never sees."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """The model from rows that are not held out; None without labels of both kinds."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total = {r["toxic"]: r["c"] for r in known.groupBy("toxic").agg(F.count("*").alias("c")).collect()}
    rates = {y: min(1.0, train_docs / c) for y, c in total.items()}
    pick = F.lit(False)
    for y, r in rates.items():
        pick = pick | ((F.col("toxic") == y) & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < int(r * (1 << 30)) + (r == 1.0)))
    sample = known.where(pick).select(F.col("doc_id").alias("_mr_id"), "toxic")  # about train_docs rows of a label: small enough to send
    texts = docs.select(docs["text"].cast("string").alias("text"), docs["doc_id"].cast("long").alias("doc_id"))
    rows = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("_mr_id")).select("text", "toxic").mapInArrow(_unit_map, "toxic int, units array<binary>").toArrow()
    if not len(rows):
        return None
    rows = rows.combine_chunks()
    return fit_arrays(rows["toxic"].to_numpy().astype(int), rows["units"].chunk(0), rates)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score), one row per input row; null and empty texts have the score of a text without units."""
    texts = docs.select(docs["text"].cast("string").alias("text"), docs["doc_id"].cast("long").alias("doc_id"))
    if model is None:
        return texts.select("doc_id", F.lit(0.0).alias("score"))
    return texts.mapInArrow(_score_map(docs.sparkSession.sparkContext.broadcast(model)), "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """docs without rows that score `limit` or more; all columns pass through, nothing is shuffled."""
    model = train(docs, labels)
    if model is None:
        return docs
    at = [c.lower() for c in docs.columns].index("text")
    return docs.mapInArrow(_keep_map(docs.sparkSession.sparkContext.broadcast(model), at, limit), docs.schema)


def op8_toxicity(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op8_toxicity": op8_toxicity}
