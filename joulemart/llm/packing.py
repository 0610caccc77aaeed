"""Pack token pieces into sequences by vector best-fit, in shards of bounded size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.llm import tokens
from joulemart.session import new_work_dir

#: Pieces that one task packs; a shard leaves about one sequence partly empty.
SHARD_PIECES = 16_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds: tokens, documents, and attention cost (the sum of squared piece lengths).

    `weights` are those of the three in the choice of a sequence. `rule` is "norm" (smallest weighted
    norm of what would be left) or "dot" (largest weighted product of what a piece needs and what is left).
    """

    tokens: int = 2048
    documents: int | None = None
    attention: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.attention or self.tokens**2], float)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and place in the bin of each piece, and the number of bins; long pieces choose first."""
    limits, weights = capacity.limits(), np.array(capacity.weights)
    needs = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], 1)
    if len(lengths) and (needs > limits).any():
        raise ValueError("a piece needs more than a whole sequence has")
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, number = np.zeros((1024, 3)), np.zeros(1024, np.int64)  # open bins only
    opened = made = 0
    smallest = needs.min(0) if len(lengths) else limits
    for i in np.argsort(-lengths, kind="stable"):
        need = needs[i]
        rest = left[:opened] - need
        if capacity.rule == "dot":
            score = -((left[:opened] * need / limits**2) @ weights)
        else:
            score = (rest / limits) ** 2 @ weights
        score[(rest < 0).any(1)] = np.inf
        at = int(score.argmin()) if opened else 0
        if not opened or score[at] == np.inf:
            if opened == len(left):
                left, number = np.concatenate([left, left]), np.concatenate([number, number])
            at, opened = opened, opened + 1
            left[at], number[at] = limits, made
            made += 1
        bins[i], places[i] = number[at], limits[0] - left[at, 0]
        left[at] -= need
        if (left[at] < smallest).any():  # nothing fits any more
            opened -= 1
            left[at], number[at] = left[opened], number[opened]
    return bins, places, made


def pack(pieces: DataFrame, length: str = "length", capacity: Capacity = Capacity(), shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Give every row a sequence_id (long) and an offset (long), its place in that sequence.

    Rows are dealt to shards by place, not by key, so that no group of equal rows meets in a shard, and
    every shard is packed by itself. `pieces` must be cheap to read twice and always give its rows in
    the same order, as a written table does. Lengths must be 1 or more; a null length is an error. Columns
    of these names are replaced. An empty table stays empty.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset", "__shard")]
    shards = max(1, math.ceil(pieces.count() / shard_pieces))
    dealt = pieces.select(*kept, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).alias("__shard"))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        bins, places, _ = best_fit(group[length].to_numpy(np.int64), capacity)
        shard = np.int64(group["__shard"].iloc[0])
        return group[kept].assign(sequence_id=(shard << 32) + bins, offset=places)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.select(*kept).schema)
    prefix = f"{schema}, " if kept else ""
    return dealt.groupBy("__shard").applyInPandas(fill, f"{prefix}sequence_id bigint, offset bigint")


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, piece_tokens: int = 2048, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Cut the token ids of every document, followed by end_id, into pieces.

    Gives key, piece (from 0), start (ids of the document before it), length, ids_crc32 and, if asked for,
    ids (array<int>). Only documents longer than a piece are cut. A null or empty text is the end id
    alone; equal rows give equal pieces.
    """
    key_type = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ids, offsets in tokens.encoded_rows(batches, tokenizer, end_id):
            lengths = np.diff(offsets)
            counts = -(-lengths // piece_tokens)
            row = np.repeat(np.arange(len(lengths)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            low = offsets[row] + piece * piece_tokens
            high = np.minimum(low + piece_tokens, offsets[row + 1])
            columns = {
                key: rows.column(rows.schema.get_field_index(key)).take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(piece * piece_tokens, pa.int64()),
                "length": pa.array(high - low, pa.int64()),
                "ids_crc32": pa.array([tokens.crc32(ids[a:b]) for a, b in zip(low, high)], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(low, len(ids)), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"`{key}` {key_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col(key), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema + ", ids array<int>" * with_ids)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: Capacity = Capacity(), key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence each is packed into; see token_pieces and pack.

    The pieces are written to the shared work folder once, so that texts are encoded once.
    """
    folder = new_work_dir(docs.sparkSession, "pieces")
    token_pieces(docs, tokenizer, end_id, capacity.tokens, key, with_ids).write.parquet(folder)
    return pack(docs.sparkSession.read.parquet(folder), capacity=capacity)
