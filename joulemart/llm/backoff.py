"""Stupid-backoff scores of documents against the n-gram counts of all other documents.

Texts are cut into blocks of whole documents. N-grams of all orders are hashed as a whole, so that a
frequent word crowds nothing, and the count table is parted by ranges of the hash:

1. A block sends each part its distinct n-grams there, with their numbers. They are sorted, so a
   few bits each beyond the part's share of the hash are enough.
2. A part sums the numbers and answers every block: how often others have each n-gram sent.
3. The answers meet the block's texts, which are scored and summed per document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joulemart.llm import text_hash

#: N-grams of a part, on average; a task holds one part.
PART_GRAMS = 3_000_000
#: Bytes of text of a block: the more, the fewer times an n-gram travels.
BLOCK_BYTES = 4 << 20
#: Rows of a block: they are numbered by 16 bits.
BLOCK_ROWS = 1 << 16
#: Hash bits: at least so many, and so many more than number the n-grams of the corpus.
LEAST_BITS, SPARE_BITS = 52, 20
#: Stands for a null key on the way.
_NO_KEY = -(1 << 63)
_GRAMS = "slot int, block bigint, mark bigint, n int, grams binary, counts binary"
_ANSWERS = "slot int, block bigint, mark bigint, others binary"
_TEXTS = "block bigint, mark bigint, size bigint, keys binary, offsets binary, data binary"


def _blocks(batches: Iterator[pa.RecordBatch]):
    """Blocks of a task: (number, crc of the text, keys, lower-cased text, offsets of the rows)."""
    part, count = TaskContext.get().partitionId(), 0
    for batch in batches:
        for low, data, offsets in text_hash.text_chunks(batch, size=BLOCK_BYTES):
            for at in range(0, len(offsets) - 1, BLOCK_ROWS):
                own = offsets[at : at + BLOCK_ROWS + 1]
                lowered = text_hash.LOWER[data[own[0] : own[-1]]]
                keys = np.asarray(batch.column(0).slice(low + at, len(own) - 1).cast(pa.int64()), np.int64)
                yield (part << 32) + count, zlib.crc32(lowered.tobytes()), keys, lowered, own - own[0]
                count += 1


def _grams_of(data: np.ndarray, offsets: np.ndarray, order: int, bits: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hashes of all n-grams, order after order; for each order the places of their last words; each row's first word."""
    starts, ends, first = text_hash.word_bounds(data, offsets, text_hash.WHITE_SPACE)
    words = text_hash.range_hashes(text_hash.prefix_hashes(data), starts, ends)
    within = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    hashes, places, gram = [], [], np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        before = np.zeros(len(words), np.uint64)
        before[1:] = gram[:-1]
        gram = text_hash.mix(before * np.uint64(text_hash._ROOT) + words + np.uint64(n))
        place = np.flatnonzero(within >= n - 1)
        hashes.append(gram[place] >> np.uint64(64 - bits))
        places.append(place)
    return np.concatenate(hashes), places, first


def _edges(slots: int, bits: int) -> list[int]:
    """Where the parts begin in the range of hashes, and its end."""
    return [-(-(s << bits) // slots) for s in range(slots + 1)]


def _low_bits(width: int, n: int) -> int:
    """How many bits of sorted numbers below width are written as they are: a multiple of four."""
    return max(0, 4 * round(math.log2(max(1, width / n)) / 4))


def pack_sorted(values: np.ndarray, width: int) -> bytes:
    """Ascending numbers below width: the low bits of each, and the high ones as steps in a bit map."""
    n, low = len(values), _low_bits(width, len(values))
    steps = np.zeros((width >> low) + n + 1, np.uint8)
    steps[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    out = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, : low // 8].tobytes()
    if low % 8:
        halves = np.zeros(n + n % 2, np.uint8)
        halves[:n] = (values >> np.uint64(low - 4)).astype(np.uint8) & 15
        out += (halves[::2] | halves[1::2] << 4).tobytes()
    return out + np.packbits(steps).tobytes()


def unpack_sorted(packed: bytes, n: int, width: int) -> np.ndarray:
    """The numbers that pack_sorted wrote."""
    low = _low_bits(width, n)
    data, at = np.frombuffer(packed, np.uint8), n * (low // 8)
    whole = np.zeros((n, 8), np.uint8)
    whole[:, : low // 8] = data[:at].reshape(n, low // 8)
    out = whole.view("<u8").ravel().astype(np.uint64)
    if low % 8:
        pairs = data[at : at + (n + 1) // 2]
        at += len(pairs)
        halves = np.stack([pairs & 15, pairs >> 4], 1).ravel()[:n]
        out |= halves.astype(np.uint64) << np.uint64(low - 4)
    high = np.flatnonzero(np.unpackbits(data[at:])) - np.arange(n)
    return out | high.astype(np.uint64) << np.uint64(low)


def pack_counts(counts: np.ndarray) -> bytes:
    """Numbers, most of them small: a byte each, those from 255 on again in full behind them."""
    large = counts >= 255
    raw = np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<i8").tobytes()
    return len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_counts(packed: bytes, n: int) -> np.ndarray:
    """The n numbers that pack_counts wrote."""
    raw = pa.decompress(packed[4:], int.from_bytes(packed[:4], "little"), codec="zstd", asbytes=True)
    counts = np.frombuffer(raw[:n], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw[n:], "<i8")
    return counts


def _rows(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_pydict({name: pa.array(list(own), kind) for (name, kind), own in zip(kinds.items(), columns)})


_NUMBERS = {"slot": pa.int32(), "block": pa.int64(), "mark": pa.int64()}


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the number of its words."""
    total = 0
    for _, _, _, data, offsets in _blocks(batches):
        total += len(text_hash.word_bounds(data, offsets, text_hash.WHITE_SPACE)[0])
    yield pa.RecordBatch.from_pydict({"words": pa.array([total], pa.int64())})


def _send_grams(order: int, bits: int, slots: int):
    """Task: the distinct n-grams of a block with their numbers, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _edges(slots, bits)
        bounds = np.array(edges, np.uint64)
        for block, mark, _, data, offsets in _blocks(batches):
            distinct, n = np.unique(_grams_of(data, offsets, order, bits)[0], return_counts=True)
            cuts = np.searchsorted(distinct, bounds)
            yield _rows(
                [
                    (s, block, mark, b - a, pack_sorted(distinct[a:b] - bounds[s], edges[s + 1] - edges[s]), pack_counts(n[a:b]))
                    for s, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist()))
                    if b > a
                ],
                **_NUMBERS, n=pa.int32(), grams=pa.binary(), counts=pa.binary(),
            )

    return run


def _answer(bits: int, slots: int):
    """Of one part: for every block, how often other blocks have each of its n-grams."""

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        slot = rows[0]["slot"]
        edges = _edges(slots, bits)
        width = edges[slot + 1] - edges[slot]
        grams = np.concatenate([unpack_sorted(r["grams"], r["n"], width) for r in rows])
        own = np.concatenate([unpack_counts(r["counts"], r["n"]) for r in rows])
        _, at = np.unique(grams, return_inverse=True)
        del grams
        others = np.bincount(at, weights=own).astype(np.int64)[at] - own
        ends = np.cumsum([r["n"] for r in rows])
        out = [(slot, r["block"], r["mark"], pack_counts(others[end - r["n"] : end])) for r, end in zip(rows, ends.tolist())]
        return pa.Table.from_batches([_rows(out, **_NUMBERS, others=pa.binary())])

    return run


def _send_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: the texts of a block, compressed."""
    for block, mark, keys, data, offsets in _blocks(batches):
        packed = pa.compress(data.tobytes(), codec="zstd", asbytes=True)
        yield _rows(
            [(block, mark, len(data), keys.tobytes(), offsets.astype("<i8").tobytes(), packed)],
            block=pa.int64(), mark=pa.int64(), size=pa.int64(), keys=pa.binary(), offsets=pa.binary(), data=pa.binary(),
        )


def _score(order: int, bits: int, slots: int, total: int, backoff: float):
    """Of one block: its texts and the answers to its n-grams become a row for each document."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if len(texts) != 1 or set(answers["mark"].to_pylist()) - {texts["mark"][0].as_py()}:
            raise ValueError("the documents gave other rows when they were read again")
        text = texts.to_pylist()[0]
        keys, offsets = np.frombuffer(text["keys"], np.int64), np.frombuffer(text["offsets"], np.int64)
        data = np.frombuffer(pa.decompress(text["data"], text["size"], codec="zstd", asbytes=True), np.uint8)
        grams, places, first = _grams_of(data, offsets, order, bits)
        distinct, at, here = np.unique(grams, return_inverse=True, return_counts=True)
        del grams
        sizes = np.diff(np.searchsorted(distinct, np.array(_edges(slots, bits), np.uint64)))
        others = np.zeros(len(distinct), np.int64)
        ends = np.cumsum(sizes)
        for slot, packed in zip(answers["slot"].to_pylist(), answers["others"].to_pylist()):
            others[ends[slot] - sizes[slot] : ends[slot]] = unpack_counts(packed, sizes[slot])
        row_of = np.repeat(np.arange(len(keys)), np.diff(first))
        # An n-gram's number without those in the document itself.
        held = (others + here)[at]
        _, own, times = np.unique(at << 16 | np.concatenate([row_of[p] for p in places]), return_inverse=True, return_counts=True)
        held -= times[own]
        seen = np.full((order + 1, len(row_of)), -1, np.int64)
        for n, (place, part) in enumerate(zip(places, np.split(held, np.cumsum([len(p) for p in places])[:-1])), 1):
            seen[n, place] = part
        words = np.diff(first)
        left = np.log(np.maximum(total - words, 1))
        value, steps, open_ = -left[row_of], np.zeros(len(row_of), np.int64), np.ones(len(row_of), bool)
        for n in range(order, 0, -1):
            found = open_ & (seen[n] > 0)
            steps += open_ & (seen[n] == 0)
            i = np.flatnonzero(found)
            value[i] = np.log(seen[n, i]) - (np.log(seen[n - 1, i - 1]) if n > 1 else left[row_of[i]])
            open_ &= ~found
        value += steps * math.log(backoff)
        sums = np.bincount(row_of, weights=value, minlength=len(keys))
        some = words > 0
        return pa.table({
            "row_id": keys,
            "n_words": pa.array(words, pa.int64()),
            "n_backed_off": pa.array(np.bincount(row_of, weights=steps, minlength=len(keys)).astype(np.int64)),
            "score": pa.array(np.where(some, sums / np.maximum(words, 1), 0.0), mask=~some),
        })

    return run


def backoff_scores(docs: DataFrame, backoff: float = 0.4, order: int = 3, key: str = "doc_id") -> DataFrame:
    """The mean log score of every document's words under the n-gram counts of all other documents.

    Gives key (long), n_words, n_backed_off and score (double). After lower-casing A-Z, words are runs of
    other than ASCII white space. Counts of n-grams of 1 to `order` words are those of the corpus less those of
    the scored document itself; otherwise none would ever be unseen. A word scores the count of the longest n-gram
    that ends in it and others hold, over the count of that n-gram without the word (of one word: over the number
    of words of others), times `backoff` for each longer n-gram that begins in the document. A word that no other
    document holds scores backoff once more over the number of others' words. n_backed_off is the number of these
    steps. Null, empty and blank texts have no words and a null score. Rows with equal or null keys stay rows
    of their own; each is a document. An empty table gives no rows.

    The documents are read three times and must give the same rows in the same order each time, as tables of
    files do; otherwise the query fails. N-grams are told apart by hashes of at least 52 bits, and of 20 more than
    number the n-grams: one in a million may share its hash with another.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NO_KEY)).alias("row_id"), F.col("text").cast("string").alias("text"))
    total = texts.mapInArrow(_count_words, "words bigint").agg(F.sum("words")).first()[0] or 0
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total * order / PART_GRAMS))
    bits = min(63, max(LEAST_BITS, (total * order).bit_length() + SPARE_BITS))
    answers = texts.mapInArrow(_send_grams(order, bits, slots), _GRAMS).groupBy("slot").applyInArrow(_answer(bits, slots), _ANSWERS)
    blocks = texts.mapInArrow(_send_texts, _TEXTS)
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(order, bits, slots, total, backoff), "row_id bigint, n_words bigint, n_backed_off bigint, score double"
    )
    own = F.when(F.col("row_id") != _NO_KEY, F.col("row_id"))
    return scored.select(own.alias(key), "n_words", "n_backed_off", "score")
