"""Supervised subword embeddings: averaged vectors of words and character n-grams, softmax on top.

A document is the mean of the vectors of its words, its character n-grams, repeats of a word and a
constant, all by hashed bucket. The vectors and the output layer are learned with numpy by stochastic gradient descent on a
bounded sample of labelled rows; scoring needs no more than one number per bucket, as the output is
linear in the mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joulemart.llm import text_hash

#: Labelled rows that a fit takes at most; the rest of a corpus is scored, not learned from.
SAMPLE_ROWS = 2_000


_REPEAT = 0x2545F4914F6CDD1D


@dataclass(frozen=True)
class Settings:
    """Sizes and rates of a fit; the last bucket is the constant's."""

    buckets: int = 1 << 18
    dims: int = 10
    char_ngrams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 8
    rate: float = 0.5
    seed: int = 7


def text_features(data: np.ndarray, offsets: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers of the features of a run of texts, one kind at a time, and the rows' bounds in each."""
    starts, ends, first = text_hash.word_bounds(data, offsets, text_hash.WHITE_SPACE)
    words = text_hash.range_hashes(text_hash.prefix_hashes(data), starts, ends)
    yield (words % np.uint64(settings.buckets)).astype(np.int64), first
    # A word that only repeats the one before it is a feature of its own, whatever the word.
    again = np.flatnonzero(words[1:] == words[:-1]) + 1
    again = again[~np.isin(again, first)]
    yield np.full(len(again), int(_REPEAT % settings.buckets)), np.searchsorted(again, first)
    # Characters as their UTF-8 bytes in one number; white space stands for the border of a word.
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[begins].astype(np.uint64)
    after = np.append(begins[1:], len(data))
    for k in (1, 2, 3):
        more = after - begins > k
        code[more] = code[more] << np.uint64(8) | data[begins[more] + k]
    border = text_hash.WHITE_SPACE[data[begins]]
    code[border] = 32
    inner = np.concatenate([[0], np.cumsum(border)])
    bounds = np.searchsorted(begins, offsets)
    row_end = np.repeat(bounds[1:], np.diff(bounds))
    for n in settings.char_ngrams:
        at = np.arange(max(0, len(code) - n + 1))
        # Border characters only at the ends, and all of one text.
        at = at[(inner[at + n - 1] == inner[at + 1]) & (at + n <= row_end[at])]
        value = np.full(len(at), n, np.uint64)
        for k in range(n):
            value = (value + code[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        yield (text_hash.mix(value) % np.uint64(settings.buckets)).astype(np.int64), np.searchsorted(at, bounds)


def _fitted(settings: Settings):
    """Task, the only one: the model of all its rows, of which the number is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags = []
        for batch in batches:
            for low, data, offsets in text_hash.text_chunks(batch):
                kinds = list(text_features(data, offsets, settings))
                rows = batch.slice(low, len(offsets) - 1)
                places, labels = (rows.column(rows.schema.get_field_index(c)).to_pylist() for c in ("place", "label"))
                for row, (place, label) in enumerate(zip(places, labels)):
                    found = [np.array([settings.buckets])] + [b[bounds[row] : bounds[row + 1]] for b, bounds in kinds]
                    bucket, n = np.unique(np.concatenate(found), return_counts=True)
                    bags.append((place, label, bucket.astype(np.uint32), (n / n.sum()).astype(np.float32)))
        if bags:
            # Rows arrive in any order; learning goes by the order of their hash.
            bags.sort(key=lambda bag: (bag[0], bag[1], len(bag[2])))
            model = train([bag[1:] for bag in bags], settings)
            yield pa.RecordBatch.from_pydict({"model": pa.array([model.tobytes()], pa.binary())})

    return run


def train(bags: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings = Settings()) -> np.ndarray:
    """What each bucket adds to the log odds of label 1, from (label, buckets, shares) rows."""
    random = np.random.default_rng(settings.seed)
    vectors = random.uniform(-1 / settings.dims, 1 / settings.dims, (settings.buckets + 1, settings.dims))
    output = np.zeros((settings.dims, 2))
    steps, step = settings.epochs * len(bags), 0
    for _ in range(settings.epochs):
        for i in random.permutation(len(bags)):
            label, bucket, share = bags[i]
            rate = settings.rate * (1 - step / steps)
            hidden = share @ vectors[bucket]
            logits = hidden @ output
            chance = np.exp(logits - logits.max())
            error = chance / chance.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            # A mean leaves each vector a small share of the step; the root of their number evens that out.
            vectors[bucket] -= (rate * np.sqrt(len(bucket)) * share)[:, None] * back
            step += 1
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", label: str = "quality") -> np.ndarray:
    """Learn from at most sample_rows labelled documents, chosen by a hash of their key.

    Labels other than 0 and 1, null keys and labels without a document are left out; a key with both
    labels counts as 0. Rows that share a key count each; of more than sample_rows rows those with the
    smallest hash of key and text stay. Without any label all scores are one half.
    """
    chosen = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key")).agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("__key"), "__key").limit(sample_rows)
    )
    texts = docs.select(F.col(key).alias("__key"), F.col("text").cast("string").alias("text"))
    # At most sample_rows keys are sent out; a key that very many rows have gives no more than its share.
    labelled = texts.join(F.broadcast(chosen), "__key").select(F.xxhash64("__key", "text").alias("place"), "label", "text")
    # Which rows stay must not depend on where they lie.
    labelled = labelled.orderBy("place", "label").limit(sample_rows)
    rows = labelled.coalesce(1).mapInArrow(_fitted(settings), "model binary").collect()
    return np.frombuffer(rows[0]["model"], np.float32) if rows else np.zeros(settings.buckets + 1, np.float32)


def score(docs: DataFrame, model: np.ndarray, settings: Settings = Settings(), column: str = "score") -> DataFrame:
    """Add the chance of label 1 (double, 0 to 1) by each row's whole text.

    A null, empty or blank text is scored by the constant alone. A column of that name is replaced; all
    other columns stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != column]
    texts, name = text_hash.with_text(docs.select(*kept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for low, data, offsets in text_hash.text_chunks(batch, name):
                total = np.full(len(offsets) - 1, float(weights[settings.buckets]))
                count = np.ones(len(offsets) - 1)
                for bucket, bounds in text_features(data, offsets, settings):
                    sums = np.concatenate([[0.0], np.cumsum(weights[bucket], dtype=np.float64)])
                    total += sums[bounds[1:]] - sums[bounds[:-1]]
                    count += np.diff(bounds)
                rows = batch.slice(low, len(total))
                arrays = [rows.column(rows.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(1 / (1 + np.exp(-total / count)))], [*kept, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return texts.mapInArrow(run, f"{fields}, `{column}` double")


def held_out(key: Column) -> Column:
    """Whether a row is kept from all learning, as a row without a key always is."""
    return key.isNull() | (F.crc32(key.cast("string").cast("binary")) % 5 == 0)
