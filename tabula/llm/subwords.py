"""Subword encoding inside tasks, with bounded caches of chunks and pre-tokens.

A chunk is what stands between plain separators that no token of the
vocabulary can cross; it is worked out once and then looked up.  Caches keep
two generations of at most ``limit`` bytes and no long chunks, so what recurs
stays and a worker's memory follows neither the corpus nor its longest words.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from struct import pack

import pyarrow as pa

CACHE_LIMIT = 48 << 20  # bytes of a generation
LONGEST_KEPT = 256  # characters; longer chunks hardly recur
ENTRY_BYTES = 160  # what an entry takes beside its key and value
ROWS_AT_ONCE = 128
#: Up to here (Latin letters) lower-casing and composition work per character.
SIMPLE = re.compile("[\x00-į]*").fullmatch


def vocabulary_file(path: str) -> str:
    """A path as it is; a bare file name where this machine keeps the public
    vocabularies, so a task finds the file wherever its executor has it."""
    if os.sep in path:
        return path
    import public_tokenizers

    return public_tokenizers.path(path)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_file(path))


@lru_cache(maxsize=2)
def shared(make: Callable, path: str):
    """One encoder per worker process: its caches stay warm from task to task."""
    return make(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Small pieces of the Arrow batches, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class Recent(dict):
    """Values by key, made on demand; two generations of ``limit`` bytes stay."""

    def __init__(self, make: Callable, limit: int = CACHE_LIMIT):
        super().__init__()
        self.make, self.limit, self.old, self.held = make, limit, {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > LONGEST_KEPT:
            return value
        self.held += ENTRY_BYTES + 2 * len(key) + (0 if isinstance(value, int) else len(value) if isinstance(value, bytes) else 8 * len(value))
        if self.held > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in a byte-level vocabulary: bytes
    that print stand for themselves, the others follow from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


_LETTERS = dict(enumerate(byte_letters()))


def spelled(data: bytes) -> str:
    """Bytes in the letters of a byte-level vocabulary."""
    return data.decode("latin-1").translate(_LETTERS)


#: A stop or comma after a letter and before white space or the end is a
#: pre-token of its own; cut off, it leaves a word that recurs.
_LOWER_STOP = re.compile(r"(?<=[a-z\xdf-\xf6\xf8-\xff])([.,])(?=[ \n\t]|\Z)").sub
_STOP = re.compile(r"(?<=[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff])([.,])(?=\x00|\Z)").sub


class WordEncoder:
    """Ids of whole texts for a vocabulary that drops white space
    (``word_bpe_49k``): pre-tokens, normalisation and special strings never
    reach across a space, tab or newline, so chunks between those are
    independent."""

    def __init__(self, path: str, limit: int = CACHE_LIMIT):
        import regex

        self.tokenizer = load_tokenizer(path)
        self.merge = self.tokenizer.model.tokenize
        # fixed value: the vocabulary's own pattern
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.simple = Recent(self._simple, limit)
        self.other = Recent(self._other, limit // 8)

    def _simple(self, chunk: str) -> bytes:
        parts = [chunk] if chunk.isalpha() else self.parts(chunk)
        ids = [t.id for p in parts for t in self.merge(spelled(p.encode()))]
        return pack(f"<{len(ids)}I", *ids)

    def _other(self, chunk: str) -> bytes:
        ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def blob(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text, as bytes."""
        if SIMPLE(text) and "<|" not in text:
            known, text = self.simple, _LOWER_STOP(r" \1", text.lower())
        else:
            known = self.other
        return b"".join(map(known.__getitem__, text.replace("\n", " ").replace("\t", " ").split(" ")))


#: Where white space meets white space or an end of the text, the pattern's
#: look-ahead matters and the chunks are not independent.
_TIED = re.compile(r"\s\s|^\s|\s$").search


def space_chunks(text: str) -> list[str] | None:
    """The text cut before every space (which stays with the chunk it leads),
    around newlines and before a closing stop or comma: all ends of
    pre-tokens.  None where white space does not allow it."""
    if "\x00" in text or _TIED(text):
        return None
    return _STOP("\x00\\1", text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")).split("\x00")
