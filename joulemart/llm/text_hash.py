"""Words and shingles of Arrow text columns as 64-bit hashes, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text worked on at a time; scratch arrays take about fifty times as much.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_ROOT = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def with_text(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with their text as a string column, and its name: `text` itself, where it is one."""
    if dict(docs.dtypes)["text"] == "string":
        return docs, "text"
    return docs.withColumn("__text", F.col("text").cast("string")), "__text"


def byte_table(members: bytes) -> np.ndarray:
    """A look-up table that is true for the given byte values."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


#: Space and the control characters from tab to carriage return.
WHITE_SPACE = byte_table(b" \t\n\x0b\x0c\r")
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_chunks(batch: pa.RecordBatch, column: str = "text", size: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows: (first row, text bytes, row offsets into them).

    A null text counts as empty. A single row longer than a chunk is a chunk of its own.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    first, rows = texts.offset, len(texts)
    if not rows:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[first : first + rows + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.zeros(0, np.uint8)
    low = 0
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + (size or CHUNK_BYTES), "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    out = values ^ (values >> _U(30))
    out *= _U(0xBF58476D1CE4E5B9)
    out ^= out >> _U(27)
    out *= _U(0x94D049BB133111EB)
    out ^= out >> _U(31)
    return out


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the root and of its inverse, up to the n-th."""
    global _powers
    if len(_powers[0]) < n:
        inverse = pow(_ROOT, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers = tuple(
                np.concatenate([np.ones(1, _U), np.cumprod(np.full(n - 1, root, _U))]) for root in (_ROOT, inverse)
            )
    return _powers


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling sums from which the hash of any byte range follows; see range_hashes."""
    up, _ = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges; equal bytes give equal hashes wherever they stand."""
    _, down = _power_tables(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def word_bounds(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all runs of bytes that are not `outside`, and each row's first run.

    The third array has one entry more than there are rows: row r has runs first[r] to first[r + 1].
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~outside[data]
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    # A row's border ends a run even where no separator stands.
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    both = borders[inside[borders] & inside[borders + 1]]
    opens[both] = True
    closes[both - 1] = True
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words within a row, and each one's row.

    A row with fewer words, but at least one, has its whole sequence as its only shingle.
    """
    rows = len(first) - 1
    row_of = np.repeat(np.arange(rows), np.diff(first))
    count = np.diff(first)
    n = max(0, len(words) - width + 1)
    whole = row_of[:n] == row_of[width - 1 : width - 1 + n] if n else np.zeros(0, bool)
    hashes = np.full(n, width, _U)
    for i in range(width):
        hashes = mix(hashes * _U(_ROOT) + words[i : i + n])
    short = np.flatnonzero((count > 0) & (count < width))
    shorter = np.empty(len(short), _U)
    for length in range(1, width):
        at = np.flatnonzero(count[short] == length)
        value = np.full(len(at), length, _U)
        for i in range(length):
            value = mix(value * _U(_ROOT) + words[first[short[at]] + i])
        shorter[at] = value
    return np.concatenate([hashes[whole], shorter]), np.concatenate([row_of[:n][whole], short])


def distinct_by_row(hashes: np.ndarray, row_of: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct hashes of every row, one row after the other, and the offsets of the rows."""
    order = np.lexsort((hashes, row_of))
    hashes, row_of = hashes[order], row_of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row_of[1:] != row_of[:-1])
    return hashes[new], np.searchsorted(row_of[new], np.arange(rows + 1))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int, outside: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row after lower-casing A-Z; see distinct_by_row."""
    lowered = LOWER[data]
    starts, ends, first = word_bounds(lowered, offsets, outside)
    words = range_hashes(prefix_hashes(lowered), starts, ends)
    hashes, row_of = shingle_hashes(words, first, width)
    return distinct_by_row(hashes, row_of, len(offsets) - 1)
