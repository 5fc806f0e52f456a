"""Token ids in training order: fixed-stride binary shards behind a keyed permutation.

Each text becomes token ids of a public byte-level BPE vocabulary plus an end token, cut
into sequences of `seq_len`. A first pass counts the rows of each partition and finds the longest text.
A sequence then has the index row * W + its number in the text, where rows are numbered 0..D-1 in the
table's order and W is above any text's number of sequences; a keyed Feistel network with
cycle-walking permutes the indices 0..D*W-1. The order of the permuted indices is the training
order: equal ranges of them make up the shards, each a partition of its own, and a sequence's
global slot is its rank, the sequences of the shards before plus its place in the shard. Texts are
tokenised once and shuffled once, as ids: numbers without gaps would take a second
tokenisation or a second copy of all ids.

A shard is a file of records of one size: doc_id int64, number int32, tokens int32, then
seq_len ids as uint16, little-endian, unused ones the end token. Slot s lies in the shard
with the last base <= s, at byte (s - base) * stride, so a reader can resume at any slot.
Files are written under another name and renamed when whole; a task that is run again
writes the same bytes. The manifest (shard, base, records) is a Parquet table beside them.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import common as C

U64 = C.U64
SEQ_LEN = 512
HEADER = 16
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published pre-token pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
SHARD_BYTES = 128 << 20


def encoder(ranks: bytes, pattern: str = PATTERN):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("millrace", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def feistel(x: np.ndarray, size: int, key: int, rounds: int = 6) -> np.ndarray:
    """Keyed permutation of 0..size-1 (size up to 2**62), applied to each of x."""
    half = max(1, (max(2, size) - 1).bit_length() + 1 >> 1)
    mask, shift = U64((1 << half) - 1), U64(half)
    keys = C.mix(np.arange(1, rounds + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(key & (1 << 64) - 1))
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):  # cycle-walking: the domain is less than four times as large
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (C.mix(right ^ k) & mask)
        out[todo] = left << shift | right
        todo = todo[out[todo] >= U64(size)]
    return out.astype(np.int64)


def _sequences(ranks_b, pattern: str, seq_len: int, first_b, width: int, size: int, key: int, shards: int):
    def run(batches):
        from pyspark import TaskContext

        enc = encoder(ranks_b.value, pattern)
        per = -(-size // shards)
        row, end = first_b.value.get(TaskContext.get().partitionId(), (0, 0))
        for batch in batches:
            ids = batch.column(1).to_pylist()
            rows: list[list] = [[], [], [], [], []]
            held = 0

            def out():
                index, doc, num, n, data = rows
                slot = feistel(np.array(index, np.int64), size, key)
                return pa.RecordBatch.from_arrays(
                    [pa.array((slot // per).astype(np.int32)), pa.array(slot), pa.array(doc, pa.int64()), pa.array(num, pa.int32()), pa.array(n, pa.int32()), pa.array(data, pa.binary())],
                    ["shard", "slot", "doc_id", "seq", "n_tokens", "ids"],
                )

            for d, text in zip(ids, batch.column(0)):
                if row >= end:
                    raise RuntimeError("the table gave other rows than when they were counted")
                toks = np.array([*enc.encode_ordinary(text.as_py()), END], np.uint16)
                for j in range(0, len(toks), seq_len):
                    part = toks[j : j + seq_len]
                    for col, v in zip(rows, (row * width + j // seq_len, d, j // seq_len, len(part), part.tobytes())):
                        col.append(v)
                    held += 2 * len(part)
                row += 1
                if held > 4 << 20:
                    yield out()
                    rows, held = [[], [], [], [], []], 0
            yield out()
        C.release()

    return run


def _length_map(ranks_b, pattern: str, at: int):
    """Rows as they are, and the number of tokens of the text at a place."""

    def run(batches):
        enc = encoder(ranks_b.value, pattern)
        for batch in batches:
            n = [0 if t is None or not t else len(enc.encode_ordinary(t)) + 1 for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])
        C.release()

    return run


def token_lengths(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens), one row per input row: token ids of the text and the end token, 0 for null and empty texts."""
    with open(vocabulary, "rb") as f:
        ranks_b = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return rows.mapInArrow(_length_map(ranks_b, pattern, 1), "doc_id long, n_tokens long")


def _write_map(path: str, seq_len: int):
    """Writes each shard of a sorted partition; gives the place of every sequence."""

    def run(batches):
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(path)
        end = np.uint16(END).tobytes()
        current, stream, temp, pos = None, None, "", 0

        def close():
            stream.close()
            fs.move(temp, f"{root}/shard-{current:08d}.bin")

        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(("shard", "slot", "doc_id", "seq", "n_tokens", "ids"))}
            shard, place = cols["shard"].to_pylist(), []
            for s, d, q, n, ids in zip(shard, cols["doc_id"].to_pylist(), cols["seq"].to_pylist(), cols["n_tokens"].to_pylist(), cols["ids"].to_pylist()):
                if s != current:
                    if stream is not None:
                        close()
                    current, temp, pos = s, f"{root}/.{uuid.uuid4().hex}", 0
                    stream = fs.open_output_stream(temp, buffer_size=1 << 20)
                stream.write(np.int64(-1 if d is None else d).tobytes() + np.array([q, n], np.int32).tobytes() + ids + end * (seq_len - n))
                place.append(pos)
                pos += 1
            yield pa.RecordBatch.from_arrays([cols["doc_id"], cols["seq"], cols["n_tokens"], cols["shard"], pa.array(place, pa.int64())], ["doc_id", "seq", "n_tokens", "shard", "pos"])
        if stream is not None:
            close()

    return run


def write_shards(docs: DataFrame, path: str | None = None, text: str = "text", key: str = "doc_id", seq_len: int = SEQ_LEN, seed: int = 20240229, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> tuple[DataFrame, str]:
    """Writes the shards and their manifest to a shared folder; returns the places and the folder.

    Places: doc_id, seq, n_tokens, shard, slot, byte_offset, one row per sequence. Null and
    empty texts have no sequence. A null id is written as -1. Ids play no part in the order: rows that
    repeat one have places of their own. docs must give its rows in the same order each time it is read, as
    stored tables do; if it gives more rows than were counted, the job fails. Other columns play no part.
    """
    spark = docs.sparkSession
    path = path or C.new_path(spark, "shards")
    stride = HEADER + 2 * seq_len
    texts = docs.select(docs[text].cast("string").alias("text"), docs[key].cast("long").alias("doc_id")).where("length(text) > 0")
    # a row per partition of the table
    stat = sorted(texts.groupBy(F.spark_partition_id().alias("pid")).agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("most"), F.sum(F.octet_length("text").cast("long")).alias("total")).collect())
    ends = np.cumsum([r["n"] for r in stat], dtype=np.int64).tolist()
    first = {r["pid"]: (e - r["n"], e) for r, e in zip(stat, ends)}
    width = max([r["most"] for r in stat], default=0) // seq_len + 2  # a token is a byte at least, the end token one more
    size = max(1, ends[-1] if ends else 0) * width
    shards = max(1, C.shuffle_partitions(spark), sum(r["total"] for r in stat) // SHARD_BYTES)
    with open(vocabulary, "rb") as f:  # under a MB, read on the driver and sent to the tasks
        ranks_b = spark.sparkContext.broadcast(f.read())
    seqs = texts.mapInArrow(_sequences(ranks_b, pattern, seq_len, spark.sparkContext.broadcast(first), width, size, seed, shards), "shard int, slot long, doc_id long, seq int, n_tokens int, ids binary")
    dealt = seqs.repartitionById(shards, "shard").sortWithinPartitions("shard", "slot")
    make_folder(path)
    places = C.materialize(dealt.mapInArrow(_write_map(path, seq_len), "doc_id long, seq int, n_tokens int, shard int, pos long"), "places")
    counts = places.groupBy("shard").agg(F.count("*").alias("records"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    manifest = counts.select("shard", "records", F.coalesce(F.sum("records").over(before), F.lit(0)).alias("base"), F.lit(stride).alias("stride"))
    manifest.coalesce(1).write.parquet(f"{path}/manifest")
    manifest = spark.read.parquet(f"{path}/manifest")
    out = places.join(manifest.select(F.col("shard").alias("s"), "base"), F.col("shard") == F.col("s"))
    return out.select("doc_id", F.col("seq").cast("long"), F.col("n_tokens").cast("long"), F.col("shard").cast("long"), (F.col("base") + F.col("pos")).alias("slot"), (F.col("pos") * stride).alias("byte_offset")), path


def make_folder(path: str) -> None:
    from pyarrow.fs import FileSystem

    fs, root = FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)


def read_slots(spark: SparkSession, path: str, start: int = 0, count: int | None = None, seq_len: int = SEQ_LEN) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(slot, doc_id, number, ids) in training order from any slot on."""
    from pyarrow.fs import FileSystem

    fs, root = FileSystem.from_uri(path)
    stride = HEADER + 2 * seq_len
    left = count
    for m in spark.read.parquet(f"{path}/manifest").orderBy("base").toLocalIterator():
        if m["base"] + m["records"] <= start:
            continue
        with fs.open_input_file(f"{root}/shard-{m['shard']:08d}.bin") as f:
            at = max(0, start - m["base"])
            f.seek(at * stride)
            for i in range(at, m["records"]):
                if left == 0:
                    return
                raw = f.read(stride)
                doc, (num, n) = int(np.frombuffer(raw, np.int64, 1)[0]), np.frombuffer(raw, np.int32, 2, 8)
                yield m["base"] + i, doc, int(num), np.frombuffer(raw, np.uint16, int(n), HEADER)
                left = None if left is None else left - 1


def op7_token_shards(spark, sf_dir):
    return write_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))[0]


QUERIES = {"op7_token_shards": op7_token_shards}
