"""Token ids in files under one canonical length-limited Huffman code, read back block by block.

A written folder has three tables: `blocks` (the ids of whole documents, in ascending key order),
`code` (the code length of each id; canonical codes follow from the lengths) and `parts` (ids per part).
A block is decoded by itself: its checkpoints give the bit at which every STEP-th id begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from joulemart.llm import tokens
from joulemart.session import new_work_dir

#: Longest code in bits; at least the bits that number all distinct ids.
MAX_BITS = 16
#: Ids between two checkpoints, and the ids after which a block ends with its document.
STEP = 64
BLOCK_IDS = 1 << 17


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most max_bits for positive counts, by package-merge."""
    n = len(counts)
    max_bits = max(max_bits, int(np.ceil(np.log2(max(n, 2)))))
    if n <= 1:
        return np.ones(n, np.int64)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    packages, from_leaf = np.zeros(0), []
    for _ in range(max_bits):
        weights = np.concatenate([leaves, packages])
        rank = np.argsort(weights, kind="stable")
        from_leaf.append(rank < n)
        weights = weights[rank]
        packages = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(from_leaf):
        own = int(is_leaf[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


def _stored(width: int) -> str:
    return f"<u{width}"


class Code:
    """Encoder and decoder tables of ids and their code lengths."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        self.ids, self.lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        self.bits = int(self.lengths[-1]) if len(ids) else 1
        # Left-aligned canonical codes are the running sum of the shares of the code space before.
        shares = 1 << (self.bits - self.lengths)
        self.codes = np.cumsum(shares) - shares
        size = int(self.ids.max()) + 1 if len(ids) else 0
        self.code_of, self.length_of = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.code_of[self.ids], self.length_of[self.ids] = self.codes, self.lengths
        self.table = np.repeat(np.arange(len(self.ids)), shares)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of ids, padded to bytes, and the bit at which every STEP-th id begins."""
        lengths = self.length_of[ids]
        ends = np.cumsum(lengths)
        at = ends - lengths
        total = int(ends[-1]) if len(ids) else 0
        out = np.zeros(total // 8 + 5, np.uint8)
        byte = at >> 3
        window = self.code_of[ids] << (np.uint64(40 - self.bits) - (at & 7).astype(np.uint64))
        first = np.flatnonzero(np.diff(byte, prepend=-1))
        # Codes that begin in one byte have no bit in common, so that their sum is their union.
        if len(ids):
            window = np.add.reduceat(window, first)
            for i in range(5):
                # Later bytes of windows that begin in different bytes meet in one place.
                np.add.at(out, byte[first] + i, ((window >> np.uint64(32 - 8 * i)) & np.uint64(255)).astype(np.uint8))
        return out[: (total + 7) // 8].tobytes(), at[::STEP].astype(np.int64)

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The n ids of a block: one id of every stretch between checkpoints at a time."""
        data = np.concatenate([np.frombuffer(bits, np.uint8), np.zeros(8, np.uint8)]).astype(np.uint64)
        out = np.zeros(len(checkpoints) * STEP, np.int32)
        at = checkpoints.copy()
        limit = len(bits) * 8
        shift = np.uint64(40 - self.bits)
        mask = np.uint64((1 << self.bits) - 1)
        for step in range(min(STEP, n)):
            byte = np.minimum(at, limit) >> 3
            window = data[byte] << np.uint64(32)
            for i in range(1, 5):
                window |= data[byte + i] << np.uint64(32 - 8 * i)
            place = (window >> (shift - (at & 7).astype(np.uint64))) & mask
            symbol = self.table[place.astype(np.int64)]
            out[step::STEP] = self.ids[symbol]
            at += self.lengths[symbol]
        return out[:n]


def count_ids(stored: DataFrame, width: int) -> DataFrame:
    """How often each id of `width` bytes occurs, as (id, n); every task counts its own rows first."""

    kind = _stored(width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for payload in batch.column(0):
                found = np.bincount(np.frombuffer(payload.as_buffer(), kind))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "n": pa.array(total[ids], pa.int64())})

    return stored.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, key: str = "doc_id") -> None:
    """Encode every text, append end_id, and write all ids in ascending key order below folder.

    A null or empty text is the end id alone, null keys come first, and rows with equal keys are all
    written. An empty table gives files without blocks. The ids are kept in the work folder in between,
    so that texts are encoded once; the code is counted over all of them.
    """
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    # In between, an id takes two bytes where the vocabulary allows it.
    width = 2 if max(tokens.encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4

    def to_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, offsets in tokens.encoded_rows(batches, tokenizer, end_id):
            packed = ids.astype(_stored(width))
            yield pa.RecordBatch.from_pydict({
                key: rows.column(rows.schema.get_field_index(key)),
                "ids": pa.array([packed[a:b].tobytes() for a, b in zip(offsets, offsets[1:])], pa.binary()),
            })

    scratch = new_work_dir(spark, "token-ids")
    texts = docs.select(F.col(key), F.col("text").cast("string").alias("text"))
    texts.mapInArrow(to_ids, f"`{key}` {key_type}, ids binary").write.option("compression", "zstd").parquet(scratch)
    stored = spark.read.parquet(scratch)

    # As many rows as the vocabulary has ids, whatever the input.
    counted = count_ids(stored, width).toPandas().sort_values("id")
    lengths = code_lengths(counted["n"].to_numpy(np.int64))
    code_ids = counted["id"].to_numpy(np.int64)
    code_rows = pd.DataFrame({"id": code_ids, "bits": lengths})
    spark.createDataFrame(code_rows, "id bigint, bits bigint").coalesce(1).write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast((code_ids, lengths))

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Code(*shared.value), TaskContext.get().partitionId()
        keys, rows, size, block, start = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(rows)
            bits, checkpoints = code.encode(ids)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()),
                "block": pa.array([block], pa.int64()),
                "start": pa.array([start], pa.int64()),
                "keys": pa.array([keys], pa.list_(key_arrow)),
                "sizes": pa.array([[len(r) for r in rows]], pa.list_(pa.int64())),
                "checkpoints": pa.array([checkpoints], pa.list_(pa.int64())),
                "bits": pa.array([bits], pa.binary()),
            })

        for batch in batches:
            key_arrow = batch.column(0).type
            for name, payload in zip(batch.column(0), batch.column(1)):
                keys.append(name.as_py())
                rows.append(np.frombuffer(payload.as_buffer(), _stored(width)))
                size += len(rows[-1])
                if size >= BLOCK_IDS:
                    yield flush()
                    block, start = block + 1, start + size
                    keys, rows, size = [], [], 0
        if rows:
            yield flush()

    # The second key parts the rows of one key, should there be very many.
    numbered = stored.select(key, "ids", F.monotonically_increasing_id().alias("__row"))
    ordered = numbered.repartitionByRange(F.col(key).asc_nulls_first(), "__row").sortWithinPartitions(F.col(key).asc_nulls_first(), "__row")
    blocks = ordered.select(key, "ids").mapInArrow(
        to_blocks,
        f"part int, block bigint, start bigint, keys array<{key_type}>, sizes array<bigint>, checkpoints array<bigint>, bits binary",
    )
    blocks.write.parquet(f"{folder}/blocks")
    written = spark.read.parquet(f"{folder}/blocks")
    ids_in = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda total, n: total + n)
    written.groupBy("part").agg(F.sum(ids_in).alias("n_ids")).coalesce(1).write.parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The documents of a folder: key, start (ids of all documents before), n_tokens, ids_crc32[, ids]."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row a part, as many as the writer had tasks.
    parts = spark.read.parquet(f"{folder}/parts").toPandas().sort_values("part")
    parts["before"] = parts["n_ids"].cumsum() - parts["n_ids"]
    code = spark.read.parquet(f"{folder}/code").toPandas()
    shared = spark.sparkContext.broadcast(
        (code["id"].to_numpy(), code["bits"].to_numpy(), dict(zip(parts["part"].tolist(), parts["before"].tolist())))
    )
    key_type = blocks.schema["keys"].dataType.elementType.simpleString()

    def to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_, lengths, before = shared.value
        decoder = Code(ids_, lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes = row.column("sizes").flatten().to_numpy(zero_copy_only=False)
                checkpoints = row.column("checkpoints").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = decoder.decode(row.column("bits")[0].as_py(), checkpoints, int(sizes.sum()))
                ends = np.cumsum(sizes)
                first = before[row.column("part")[0].as_py()] + row.column("start")[0].as_py()
                columns = {
                    key: row.column("keys").flatten(),
                    "start": pa.array(first + ends - sizes, pa.int64()),
                    "n_tokens": pa.array(sizes, pa.int64()),
                    "ids_crc32": pa.array([tokens.crc32(ids[b - n : b]) for n, b in zip(sizes, ends)], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"`{key}` {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return blocks.mapInArrow(to_rows, schema + ", ids array<int>" * with_ids)
