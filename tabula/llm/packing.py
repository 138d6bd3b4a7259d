"""Operator 4, best-fit packing by a configuration linear program.

Texts become token sequences cut into pieces of at most ``capacity`` tokens
and staged once.  The histogram of piece lengths has at most ``capacity``
rows, whatever the corpus, so the driver solves the packing on it: the
configuration program (how often to use each multiset of length classes that
fits one sequence) by multiplicative weights, where a knapsack dynamic program
prices the best configuration under the present weights.  Its solution is
rounded down on the real lengths, and best fit on the histogram places what
rounding leaves, into free room first.  The plan is a list of runs: "the
pieces of length l ranked a..a+n-1 go to sequences s..s+n-1 at offset o", so
its size follows the number of lengths, not of pieces.

Ranks of pieces within a length come from buckets: (length, bucket) groups are
numbered apart and the buckets' counts are summed up, so a length that a third
of the pieces share never meets in one task.

Defined results: a null or empty text is its closing id alone (one piece of
length 1); repeated rows and null ids are pieces of their own; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import python_ready, spread, stage, table
from .subwords import WordEncoder, shared, slices

CAPACITY = 2048
END_ID = 0
UNIT = 8  # tokens to a length class of the linear program
STEPS = 1500
RATE = 0.5
#: Parts of the program's solution to round down; what is left, with its short
#: pieces, fills the room that rounding leaves.  The tightest result is kept.
SHARES = (0.9, 0.6, 0.3, 0.1)


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of (doc_id, text)."""
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared(WordEncoder, vocabulary)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for part in slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(part.column(1).to_pylist()):
                blob = encoder.blob(text or "") + end
                for p, at in enumerate(range(0, len(blob), 4 * capacity)):
                    ids = blob[at : at + 4 * capacity]
                    row.append(k)
                    piece.append(p)
                    start.append(at // 4)
                    length.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_configuration(sizes: np.ndarray, weights: np.ndarray, room: int) -> np.ndarray:
    """Knapsack dynamic program: copies of each class that fit ``room`` and
    weigh most (sizes ascending)."""
    value, choice = np.zeros(room + 1), np.full(room + 1, -1)
    upto = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        value[c] = value[c - 1]
        k = upto[c]
        if k:
            got = value[c - sizes[:k]] + weights[:k]
            j = int(got.argmax())
            if got[j] > value[c]:
                value[c], choice[c] = got[j], j
    copies, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            copies[choice[c]] += 1
            c -= sizes[choice[c]]
    return copies


def configuration_lp(sizes: np.ndarray, demand: np.ndarray, room: int, steps: int = STEPS,
                     rate: float = RATE) -> dict[tuple[int, ...], float]:
    """Covering program by multiplicative weights: how often to use each
    configuration so that each class is covered ``demand`` times."""
    weights, covered, used = 1.0 / demand, np.zeros(len(sizes)), {}
    for _ in range(steps):
        copies = np.minimum(best_configuration(sizes, weights, room), demand)
        own = copies > 0
        times = float((demand[own] / copies[own]).min())
        key = tuple(copies.tolist())
        used[key] = used.get(key, 0.0) + times
        gain = np.zeros(len(sizes))
        gain[own] = times * copies[own] / demand[own]
        covered += gain
        weights *= np.exp(-rate * gain)
    scale = np.average(covered, weights=demand * sizes)
    return {k: v / scale for k, v in used.items()}


class Packing:
    """Groups of sequences with the same lengths in the same order."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, dict(histogram)
        self.groups: list[list] = []  # [first sequence, sequences, lengths, room]
        self.by_room: dict[int, list[int]] = {}
        self.sequences = 0

    def _room(self, g: int) -> None:
        if self.groups[g][3] > 0:
            self.by_room.setdefault(self.groups[g][3], []).append(g)

    def open(self, lengths: tuple[int, ...], times: int) -> None:
        self.groups.append([self.sequences, times, lengths, self.capacity - sum(lengths)])
        self.sequences += times
        for x in lengths:
            self.left[x] -= times
        self._room(len(self.groups) - 1)

    def best_fit(self) -> None:
        """What is left, longest first, into the sequences with least room."""
        for length in sorted((x for x, n in self.left.items() if n), reverse=True):
            while self.left[length]:
                room = min((r for r in self.by_room if r >= length), default=None)
                if room is None:
                    many = self.capacity // length
                    times = self.left[length] // many
                    self.open((length,) * (many if times else self.left[length]), times or 1)
                    continue
                g = self.by_room[room].pop()
                if not self.by_room[room]:
                    del self.by_room[room]
                first, n, lengths, _ = self.groups[g]
                take = min(n, self.left[length])
                if take < n:  # the rest of the group stays as it is
                    self.groups.append([first + take, n - take, lengths, room])
                    self._room(len(self.groups) - 1)
                self.groups[g] = [first, take, (*lengths, length), room - length]
                self.left[length] -= take
                self._room(g)

    def runs(self) -> dict[int, np.ndarray]:
        """For each length its runs: first rank, first sequence, offset."""
        used: dict[int, int] = {}
        out: dict[int, list] = {}
        for first, n, lengths, _ in self.groups:
            at = 0
            for x in lengths:
                out.setdefault(x, []).append((used.get(x, 0), first, at))
                used[x] = used.get(x, 0) + n
                at += x
        return {x: np.array(v, dtype=np.int64) for x, v in out.items()}


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, unit: int = UNIT, steps: int = STEPS,
                 shares=SHARES) -> Packing:
    """Solve, round and complete the packing of a length histogram."""
    classes: dict[int, int] = {}
    for x, n in histogram.items():
        if n and x < capacity:
            classes[-(-x // unit)] = classes.get(-(-x // unit), 0) + n
    sizes = np.array(sorted(classes), dtype=np.int64)
    demand = np.array([classes[s] for s in sizes.tolist()], dtype=np.int64)
    used = configuration_lp(sizes, demand, capacity // unit, steps) if classes else {}
    tried = [_rounded(histogram, capacity, unit, sizes, demand, used, share) for share in shares]
    return min(tried, key=lambda p: p.sequences)


def _rounded(histogram: dict[int, int], capacity: int, unit: int, sizes: np.ndarray, demand: np.ndarray,
             used: dict[tuple[int, ...], float], share: float) -> Packing:
    """The packing that takes ``share`` of the program's solution, rounded down."""
    packing = Packing(histogram, capacity)
    pools: dict[int, list[list[int]]] = {}
    for x in sorted(histogram, reverse=True):
        if histogram[x] and x < capacity:
            pools.setdefault(-(-x // unit), []).append([x, histogram[x]])
    left = demand.copy()
    for copies, times in sorted(used.items(), key=lambda kv: (-kv[1], kv[0])):
        c = np.array(copies)
        own = c > 0
        n = min(int(share * times + 1e-9), int((left[own] // c[own]).min()))
        if n < 1:
            continue
        left -= n * c
        _instantiate(packing, pools, [int(s) for s, k in zip(sizes, copies) for _ in range(k)], n)
    packing.best_fit()
    return packing


def _instantiate(packing: Packing, pools: dict[int, list[list[int]]], slots: list[int], times: int) -> None:
    """``times`` sequences of one piece from each class in ``slots``; split
    where a class passes from one real length to the next."""
    drawn = []
    for s in slots:
        need, own = times, []
        while need:
            head = pools[s][0]
            take = min(need, head[1])
            own.append((head[0], take))
            head[1] -= take
            need -= take
            if not head[1]:
                pools[s].pop(0)
        drawn.append(own)
    cuts = sorted({c for own in drawn for c in np.cumsum([n for _, n in own]).tolist()})
    at = [0] * len(drawn)
    ends = [np.cumsum([n for _, n in own]).tolist() for own in drawn]
    before = 0
    for cut in cuts:
        packing.open(tuple(own[a][0] for own, a in zip(drawn, at)), cut - before)
        before = cut
        at = [a + (end[a] <= cut) for a, end in zip(at, ends)]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` plus (sequence_id, offset)."""
    spark = pieces.sparkSession
    buckets = 4 * spread(spark)
    pieces = stage(pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")),
                   "op4-pieces")
    sizes = pieces.groupBy("length", "bucket").count()
    # at most ``capacity`` rows: one for each possible length
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = plan_packing(histogram, capacity).runs()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
    starts = sizes.select("length", "bucket", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("own", own).join(starts, ["length", "bucket"]).withColumn(
        "rank", F.col("before") + F.col("own") - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            seq, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length).tolist():
                own = length == x
                r = runs[x]
                k = np.searchsorted(r[:, 0], rank[own], side="right") - 1
                seq[own] = r[k, 1] + rank[own] - r[k, 0]
                offset[own] = r[k, 2]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all texts with their place in the packed sequences."""
    return pack(pieces_of(docs, vocabulary, capacity), capacity)


def op4_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op4_best_fit_pack": op4_best_fit_pack}
ORACLES: dict = {}
