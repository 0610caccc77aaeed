"""Token ids of text columns by a tokenizer file, each distinct stretch of letters or marks encoded once per worker."""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from joulemart.llm.text_hash import LOWER, WHITE_SPACE, byte_table, prefix_hashes, range_hashes, text_chunks, word_bounds

#: Units a worker remembers before it starts anew; about 15 MB.
CACHE_UNITS = 300_000

_LETTERS = byte_table(bytes(range(65, 91)) + bytes(range(97, 123)))
_PLAIN = re.compile("[a-zß-öø-ÿÀ-ÖØ-Þ]+")


def _byte_characters() -> dict[int, int]:
    """Printable stand-ins of the 256 bytes, as byte-level vocabularies write them."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(rest)}


_BYTE_CHARACTERS = _byte_characters()


def text_units(data: np.ndarray, offsets: np.ndarray, joining: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text with most letters A-Z lower-cased, and starts and ends of the stretches that can be encoded
    alone, and each row's first one.

    That is a word between white space; where all its letters are ASCII or Latin-1 and it has none of the
    `joining` bytes, its runs of letters and its runs of other characters. Only these are lower-cased.
    """
    starts, ends, first = word_bounds(data, offsets, WHITE_SPACE)
    if not len(starts):
        return data, starts, ends, first
    high = data >= 0x80
    lead = data == 0xC3
    trail = np.zeros(len(data), bool)
    trail[1:] = lead[:-1]
    trail &= high & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
    good_lead = np.zeros(len(data), bool)
    good_lead[:-1] = lead[:-1] & trail[1:]
    odd = np.concatenate([[0], np.cumsum((high & ~good_lead & ~trail) | joining[data])])
    plain = odd[ends] == odd[starts]
    whole = np.zeros(len(data) + 1, np.int8)
    whole[starts[~plain]] += 1
    whole[ends[~plain]] -= 1
    lowered = np.where(np.cumsum(whole[:-1], dtype=np.int8) > 0, data, LOWER[data])
    letter = _LETTERS[data] | high
    change = np.zeros(len(data), bool)
    change[1:] = letter[1:] != letter[:-1]
    inner = np.flatnonzero(change)
    word = np.searchsorted(starts, inner, "right") - 1
    inner = inner[(word >= 0) & (inner > starts[word]) & (inner < ends[word]) & plain[word]]
    starts, ends = np.sort(np.concatenate([starts, inner])), np.sort(np.concatenate([ends, inner]))
    return lowered, starts, ends, np.searchsorted(starts, offsets)


class WordEncoder:
    """Encodes texts by their units and remembers the ids of units seen, by 64-bit hash.

    Ids equal those of encoding a whole text without special tokens. This holds for tokenizers that
    drop white space and split at it, and lower-case, as the word vocabularies do; `by_units` says so
    of a file. Other tokenizers encode whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # An apostrophe may start a contraction, and other bytes a token that is cut out of the text first.
        added = [token.content.encode()[:1] for token in self.tokenizer.get_added_tokens_decoder().values()]
        self._joining = byte_table(b"'" + b"".join(added))
        self.by_units = self._splits()
        self._forget()

    def _splits(self) -> bool:
        for text in ["Ab, cd.\n EFÉ ß12 a's#x\tñandú", "x  y", "don't stop", "Ünder### (ça) vom$$$ 3.5%", "x×y …!a"]:
            data = np.frombuffer(text.encode(), np.uint8)
            lowered, starts, ends, _ = text_units(data, np.array([0, len(data)]), self._joining)
            pieces = [i for a, b in zip(starts, ends) for i in self._unit_ids(lowered[a:b].tobytes().decode())]
            if pieces != self.tokenizer.encode(text, add_special_tokens=False).ids:
                return False
        return True

    def _forget(self) -> None:
        self._hashes, self._number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._starts, self._lengths, self._flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _unit_ids(self, unit: str) -> list[int]:
        if _PLAIN.fullmatch(unit) is None:
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        if not unit.isascii():
            unit = unit.lower().encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        return [token.id for token in self.tokenizer.model.tokenize(unit)]

    def _numbers(self, hashes: np.ndarray, units: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """Numbers of ascending hashes; `units` gives the texts of those at some places."""
        at = np.searchsorted(self._hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self._hashes)
        known[inside] = self._hashes[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            ids = [self._unit_ids(u) for u in units(new)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            self._hashes = np.insert(self._hashes, at[new], hashes[new])
            self._number = np.insert(self._number, at[new], len(self._starts) + np.arange(len(new)))
            self._starts = np.concatenate([self._starts, len(self._flat) + np.cumsum(lengths) - lengths])
            self._lengths = np.concatenate([self._lengths, lengths])
            self._flat = np.concatenate([self._flat, np.fromiter(chain.from_iterable(ids), np.int32, lengths.sum())])
            at = np.searchsorted(self._hashes, hashes)
        return self._number[at]

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by end_id, and the offsets of the texts."""
        if not self.by_units:
            texts = [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])]
            rows = [self.tokenizer.encode(t, add_special_tokens=False).ids + [end_id] for t in texts]
            ids = np.fromiter(chain.from_iterable(rows), np.int32)
            return ids, np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        if len(self._hashes) > CACHE_UNITS:
            self._forget()
        data, starts, ends, first = text_units(data, offsets, self._joining)
        hashes = range_hashes(prefix_hashes(data), starts, ends)
        distinct, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        text = data.tobytes()
        numbers = self._numbers(distinct, lambda at: [text[a:b].decode() for a, b in zip(starts[example[at]].tolist(), ends[example[at]].tolist())])
        of_unit = numbers[inverse]
        lengths = self._lengths[of_unit]
        until = np.concatenate([[0], np.cumsum(lengths)])
        # An end id follows each text: the ids of a text move on by the number of texts before it.
        bounds = until[first] + np.arange(len(first))
        ids = np.full(bounds[-1], end_id, np.int32)
        moved = np.repeat(np.arange(len(first) - 1), np.diff(first))
        places = np.arange(until[-1])
        source = np.repeat(self._starts[of_unit] - until[:-1], lengths) + places
        ids[np.repeat(moved, lengths) + places] = self._flat[source]
        return ids, bounds


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a file."""
    return WordEncoder(path)


def encoded_rows(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with a `text` column: (rows, ids, offsets). A null text counts as empty."""
    encode = encoder(path).encode
    for batch in batches:
        for low, data, bounds in text_chunks(batch):
            ids, offsets = encode(data, bounds, end_id)
            yield batch.slice(low, len(bounds) - 1), ids, offsets


def crc32(ids: np.ndarray) -> int:
    """Checksum of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
