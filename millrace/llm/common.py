"""Shared pieces of the corpus operators, above all a vectorised word hasher that works on
Arrow buffers instead of Python strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.graph import connected_components  # noqa: F401  for the operators
from millrace.storage import materialize, new_path, shared_dir  # noqa: F401

U64 = np.uint64
#: Text per numpy block: its 64-bit work arrays then take a few tens of MB.
BLOCK_BYTES = 1 << 20


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pow2_at_least(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def free(columns: list[str], name: str) -> str:
    """The name, with as many marks before it as no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def listed(counts: DataFrame, n: str, most: int) -> tuple[DataFrame, int]:
    """The most frequent entries of counts, `most` at most, and what no other's count exceeds.

    Counts are put in classes of a quarter of an octave (a few hundred rows); whole classes are taken from the top."""
    kind = F.floor(F.log2(F.col(n)) * 4).cast("int")
    sizes = sorted(((r["k"], r["c"]) for r in counts.groupBy(kind.alias("k")).agg(F.count("*").alias("c")).collect()), reverse=True)
    left, low = most, None
    for k, c in sizes:
        if c > left:
            break
        left, low = left - c, k
    if low is None:
        return counts.limit(0), int(2 ** ((sizes[0][0] + 1) / 4)) + 1 if sizes else 0
    below = [k for k, _ in sizes if k < low]
    return counts.where(kind >= low), int(2 ** ((below[0] + 1) / 4)) + 1 if below else 0


#: Entries of a list of frequent keys, at most.
LISTED = 10_000


def join_counted(rows: DataFrame, counts: DataFrame, key: str, name: str, n: str, how: str = "inner", most: int = LISTED) -> DataFrame:
    """rows joined with counts on key = name, where n tells how many rows have the key: the frequent keys are sent to
    all tasks, at most `most` of them, so that no task gets a frequent key's rows by a shuffle. Both tables are read twice."""
    hot, _ = listed(counts, n, most)
    same = F.col(key) == F.col(name)
    rest = rows.join(F.broadcast(hot.select(name)), same, "left_anti").join(counts, same, how)
    return rows.join(F.broadcast(hot), same, how).unionByName(rest)


#: Bits of the map that tells which rows may be among some.
AMONG_BITS = 1 << 23


def among(rows: DataFrame, some: DataFrame, names: tuple[str, ...] = ("doc_id", "fp")) -> DataFrame:
    """Rows with `maybe`: false only if the row's values of `names` are not among those of some. A bitmap of
    fixed size is sent to all tasks, so that most rows that a join would drop need no shuffle."""
    place = F.pmod(F.xxhash64(*names), F.lit(AMONG_BITS))
    bits = some.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("_mr_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_mr_bits"))
    bits = materialize(bits, "bits")  # a row for each 2**15 bits
    both = rows.withColumn("_mr_p", place).join(F.broadcast(bits), F.bitmap_bucket_number("_mr_p") == F.col("_mr_bucket"), "left")
    at = F.bitmap_bit_position("_mr_p")
    byte = F.conv(F.hex(F.substring("_mr_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return both.withColumn("maybe", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_mr_p", "_mr_bucket", "_mr_bits")


def text_col(df: DataFrame, name: str = "text") -> F.Column:
    return F.coalesce(df[name].cast("string"), F.lit(""))


# ---------------------------------------------------------------- numpy word hashing
_SEPS = np.zeros(256, bool)
_SEPS[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_POW: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x7FB5D329728EA185)
    h = h ^ (h >> U64(27))
    h = h * U64(0x81DADEF4BC2DD44D)
    return h ^ (h >> U64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (at least)."""
    if not _POW or len(_POW[0]) < n:
        size = max(n, BLOCK_BYTES + 65536)
        inv = pow(_BASE, -1, 1 << 64)
        out = []
        for base in (_BASE, inv):
            p = np.full(size, U64(base))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POW[:] = out
    return _POW[0], _POW[1]


def utf8_blocks(column: pa.ChunkedArray | pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of consecutive texts: (first row, end row, bytes, offsets). Nulls count as empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = arr.cast(pa.large_binary()) if not pa.types.is_large_binary(arr.type) else arr
    if arr.null_count:
        arr = arr.fill_null(b"")
    n = len(arr)
    if not n:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64, n + 1 + arr.offset)[arr.offset :]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j
    release()


def words(data: np.ndarray, offs: np.ndarray, seps: np.ndarray = _SEPS, byte: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block: (hash, start byte, end byte, first word of each text and the total)."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, U64), z, z, np.zeros(len(offs), np.int64)
    solid = ~seps[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~prev | edge[:n]))
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~nxt | edge[1:])) + 1
    p, q = powers(n + 1)
    c = np.empty(n + 1, U64)
    c[0] = 0
    np.cumsum(byte[data] * p[:n], out=c[1:])
    h = mix((c[ends] - c[starts]) * q[starts])
    return h, starts, ends, np.searchsorted(starts, offs)


class Memo:
    """Values of sorted 64-bit keys that were worked out before, at most LIMIT of them."""

    LIMIT = 1 << 17

    def __init__(self, width: int):
        self.keys, self.values = np.zeros(0, U64), np.zeros((0, width))

    def get(self, keys: np.ndarray, work) -> np.ndarray:
        """Values of sorted distinct keys; work(places) gives those of keys that are new."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out = np.empty((len(keys), self.values.shape[1]))
        out[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = work(new)
            if len(self.keys) + len(new) > self.LIMIT:
                self.keys, self.values = keys[: self.LIMIT], out[: self.LIMIT].copy()
            else:
                every = np.concatenate([self.keys, keys[new]])
                o = np.argsort(every)
                self.keys, self.values = every[o], np.concatenate([self.values, out[new]])[o]
        return out


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


# ---------------------------------------------------------------- "seen twice" bitmaps of fixed size
SEEN_BITS, FREQ_BITS = 27, 24


def release() -> None:
    """Gives freed memory back to the system, as a worker lives on between tasks."""
    import ctypes

    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def bucket_count(spark: SparkSession) -> int:
    return min(1 << 16, max(256, pow2_at_least(2 * shuffle_partitions(spark))))


def bucket_blobs(e: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Sorted 64-bit entries as one packed array for each range of their leading bits."""
    edges = np.arange(buckets, dtype=np.uint64) << U64(65 - buckets.bit_length())
    at = [*np.searchsorted(e, edges).tolist(), len(e)]
    ks = [k for k in range(buckets) if at[k] < at[k + 1]]
    return pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array([e[at[k] : at[k + 1]].tobytes() for k in ks], pa.binary())], ["bucket", "blob"])


def _bits_of(buckets: int, rare_df: int):
    def run(key, group):
        import pandas as pd

        bucket = int(key[0])
        v = np.sort(np.concatenate([np.frombuffer(b, U64) for b in group["blob"]]))
        tok = v >> U64(16)
        seen = np.zeros((1 << SEEN_BITS) // buckets, bool)
        twice = tok[1:][tok[1:] == tok[:-1]]
        seen[(twice >> U64(48 - SEEN_BITS)).astype(np.int64) - bucket * len(seen)] = True
        freq = np.zeros((1 << FREQ_BITS) // buckets, bool)
        if rare_df:
            tok = np.unique(v) >> U64(16)
            at = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
            often = tok[at[np.diff(np.append(at, len(tok))) > rare_df]]
            freq[(often >> U64(48 - FREQ_BITS)).astype(np.int64) - bucket * len(freq)] = True
        return pd.DataFrame({"bucket": [bucket], "seen": [np.packbits(seen).tobytes()], "freq": [np.packbits(freq).tobytes()]})

    return run


def class_bitmaps(blobs: DataFrame, buckets: int, rare_df: int = 0) -> tuple[bytes, bytes]:
    """Bitmaps by the leading bits of 64-bit entries (48 bits of token, 16 of owner): tokens that
    occur twice, and tokens with more than rare_df owners. The tokens of one bucket meet in one
    task, at most one array from each map task; the driver gets 2**27 + 2**24 bits, whatever the input."""
    rows = blobs.groupBy("bucket").applyInPandas(_bits_of(buckets, rare_df), "bucket int, seen binary, freq binary").collect()
    seen, freq = bytearray((1 << SEEN_BITS) // 8), bytearray((1 << FREQ_BITS) // 8)
    for r in rows:
        for whole, part in ((seen, r["seen"]), (freq, r["freq"])):
            whole[r["bucket"] * len(part) : (r["bucket"] + 1) * len(part)] = part
    return bytes(seen), bytes(freq)


def bit(bits: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The bit of each entry in a bitmap over its n leading bits."""
    i = v >> U64(64 - n)
    return (bits[(i >> U64(3)).astype(np.int64)] >> (U64(7) - (i & U64(7))).astype(np.uint8)) & np.uint8(1)
