"""Operator 5, token counts by prefix dynamic programming.

Byte-pair encoding has a local test of validity: a sequence of tokens is the
encoding of its bytes exactly when each neighbouring pair is the encoding of
the pair's bytes.  So for every prefix of a pre-token one keeps the last token
of the prefix's encoding and the number of tokens; the next prefix tries the
vocabulary entries that end there, longest first, and takes the first that may
follow the last token of the prefix it leaves (``PrefixTable.counts``).  This
yields the exact count of *every* prefix in one pass, and answers truncation
and budget questions without encoding anything again.

Prefix tables are kept for distinct pre-tokens in a bounded cache; a text's
table is the running sum over its pre-tokens.  Texts run through Arrow batches
in small slices.  There is no shuffle.

Special strings of the vocabulary inside a text count as the library counts
them (one token each).

Defined results: a null text is empty (0 bytes, 0 tokens); repeated rows and
null ids pass through; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import python_ready, table
from .subwords import CACHE_LIMIT, ENTRY_BYTES, SIMPLE, Recent, byte_letters, load_tokenizer, shared, slices, space_chunks, spelled, vocabulary_file

LIMIT = 512


class PrefixTable:
    """Exact token counts of all prefixes under a byte-level BPE vocabulary."""

    def __init__(self, path: str, limit: int = CACHE_LIMIT):
        import json

        import regex

        self.tokenizer = load_tokenizer(path)
        with open(vocabulary_file(path), encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        self.vocab = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.longest = max(map(len, self.vocab))
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        # fixed value: the vocabulary's own pattern
        self.parts = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self.limit = limit // ENTRY_BYTES
        self.follows: dict[int, bool] = {}
        self.tables = Recent(lambda p: self.counts(p.encode()), limit // 2)
        self.totals = Recent(lambda c: sum([self.tables[p][-1] for p in self.pre_tokens(c)]), limit)

    def _may_follow(self, key: int, data: bytes, left: int) -> bool:
        """Whether the vocabulary entries on both sides of ``left`` are the
        encoding of their joint bytes (``left`` 0: whether the one entry is
        its own encoding, that is, its merges lead to it)."""
        if len(self.follows) > self.limit:
            self.follows.clear()
        halves = [data[:left], data[left:]] if left else [data]
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled(data))]
        known = self.follows[key] = ids == [self.vocab[h] for h in halves]
        return known

    def counts(self, data: bytes) -> tuple[int, ...]:
        """Token counts of the prefixes of 0..n bytes of one pre-token."""
        find, known, longest, n = self.vocab.get, self.follows.get, self.longest, len(data)
        count, last, begun = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)  # last: id + 1 of the last token
        for end in range(1, n + 1):
            for start in range(0 if end <= longest else end - longest, end):
                token = find(data[start:end])
                if token is None:
                    continue
                key = last[start] << 32 | token
                ok = known(key)
                if ok is None:
                    before = begun[start]
                    ok = self._may_follow(key, data[before:end], start - before)
                if ok:
                    count[end], last[end], begun[end] = count[start] + 1, token + 1, start
                    break
        return tuple(count)

    def pre_tokens(self, text: str) -> list[str]:
        """The text cut by the vocabulary's own pattern; joined they give the text."""
        if SIMPLE(text):
            return self.parts(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def total(self, text: str) -> int:
        """Tokens of the whole text, as the library gives them: special strings
        count one each, the rest is the sum over independent chunks, or over
        all pre-tokens where white space ties the chunks together."""
        parts, n = [text], 0
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            n = len(parts) - 1
        for p in parts:
            chunks = space_chunks(p)
            if chunks is None:
                n += sum([self.tables[x][-1] for x in self.pre_tokens(p)])
            else:
                n += sum(map(self.totals.__getitem__, chunks))
        return n

    def prefix_counts(self, text: str) -> list[tuple[int, int]]:
        """(bytes, tokens) at every byte prefix of the text's running table:
        tokens of the whole pre-tokens before it plus the count of the part of
        its own pre-token.  Where a prefix ends inside white space the library
        may cut the last pre-token differently; ``truncate`` settles such a prefix."""
        out, size, tokens = [(0, 0)], 0, 0
        cuts = [] if self.special is None else list(self.special.finditer(text))
        at = 0
        for m in [*cuts, None]:
            part = text[at : m.start() if m else len(text)]
            for p in self.pre_tokens(part) if part else []:
                own = self.tables[p]
                out += [(size + k, tokens + own[k]) for k in range(1, len(own))]
                size, tokens = size + len(own) - 1, tokens + own[-1]
            if m:
                size, tokens, at = size + len(m[0].encode()), tokens + 1, m.end()
                out.append((size, tokens))
        return out

    def truncate(self, text: str, budget: int) -> str:
        """The longest prefix, in whole characters, of at most ``budget`` tokens.
        The table rules most prefixes out; one near the budget, or inside a
        special string, is settled by the sum over its own pre-tokens."""
        known, size = dict(self.prefix_counts(text)), len(text.encode())
        for k in range(len(text), 0, -1):
            if known.get(size, 0) <= budget + 1 and self.total(text[:k]) <= budget:
                return text[:k]
            size -= len(text[k - 1].encode())
        return ""


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of (doc_id, text)."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = shared(PrefixTable, vocabulary)
        for part in slices(batches):
            texts = [t or "" for t in part.column(1).to_pylist()]
            tokens = [prefixes.total(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of all documents by prefix dynamic programming."""
    return count_tokens(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


QUERIES = {"op5_token_counts": op5_token_counts}
ORACLES: dict = {}
