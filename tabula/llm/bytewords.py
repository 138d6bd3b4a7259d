"""Words of whole Arrow batches, cut in numpy on the UTF-8 bytes.

All separators are ASCII, which never occurs inside a longer UTF-8 character,
so bytes can be told apart one by one: 0 belongs to a word, 1 separates words,
2 separates words and pieces of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BYTES_AT_ONCE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_kinds(blanks: bytes, breaks: bytes = b"") -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[list(blanks)] = 1
    kinds[list(breaks)] = 2
    return kinds


@dataclass
class Words:
    """The words of some texts, in order, lower-cased (A-Z)."""

    dictionary: pa.Array  # distinct words, binary
    codes: np.ndarray  # each word's place in the dictionary
    rows: np.ndarray  # the text each word is in
    leads: np.ndarray  # whether a piece begins with the word


def text_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Pieces of the batches with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        ends, at = _offsets(batch.column(column)), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def gathered(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """The batches as lists of small pieces that hold at most ``limit`` bytes
    of text together, or one row."""
    held, size = [], 0
    for piece in text_slices(batches, column, min(limit, BYTES_AT_ONCE)):
        ends = _offsets(piece.column(column))
        own = int(ends[-1] - ends[0])
        if held and size + own > limit:
            yield held
            held, size = [], 0
        held.append(piece)
        size += own
    if held:
        yield held


def words_of_pieces(pieces: list[pa.RecordBatch], column: int, kinds: np.ndarray) -> Words:
    """``words_in`` of a column of several pieces, worked out piece by piece:
    what a text takes in numpy meanwhile is many times its size."""
    found, rows = [], 0
    for piece in pieces:
        words = words_in(piece.column(column), kinds)
        words.rows += np.int32(rows)
        rows += piece.num_rows
        found.append(words)
    if len(found) == 1:
        return found[0]
    every = pa.concat_arrays([w.dictionary for w in found]).dictionary_encode()
    places = every.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    starts = np.cumsum([0, *(len(w.dictionary) for w in found)])
    codes = [places[at + w.codes] for at, w in zip(starts, found)]
    return Words(every.dictionary, np.concatenate(codes), np.concatenate([w.rows for w in found]), np.concatenate([w.leads for w in found]))


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def words_in(column: pa.Array, kinds: np.ndarray) -> Words:
    """Words of a string column; null texts have none."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        column = pa.array([""])
    ends = _offsets(column)
    data = column.buffers()[2]
    data = _LOWER[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    kind = kinds[data]
    inside = kind == 0
    fresh = np.ones(len(data) + 1, dtype=bool)  # no word reaches here from the byte before
    fresh[1:] = ~inside
    fresh[ends] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    count = np.int32 if len(data) < 1 << 31 else np.int64
    packed = np.cumsum(inside, dtype=count)
    rows = np.searchsorted(ends, starts, "right") - 1
    breaks = np.cumsum(kind == 2, dtype=count)[starts]
    leads = np.ones(len(starts), dtype=bool)
    leads[1:] = (breaks[1:] != breaks[:-1]) | (rows[1:] != rows[:-1])
    if len(starts):
        offsets = np.append(packed[starts] - 1, packed[-1]).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    else:
        found = pa.array([], pa.large_binary())
    coded = found.dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), rows.astype(np.int32), leads)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word of a dictionary."""
    return np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in words.to_pylist()), np.uint64)


def row_ends(found: Words, rows: int) -> np.ndarray:
    """Where each text's words begin, and the last one's end."""
    return np.concatenate([[0], np.cumsum(np.bincount(found.rows, minlength=rows))])


def listed_codes(values: np.ndarray, found: Words, rows: int) -> pa.ListArray:
    """For each text the values of its words, in order."""
    return pa.ListArray.from_arrays(pa.array(row_ends(found, rows), pa.int32()), pa.array(values[found.codes].view(np.int64)))
