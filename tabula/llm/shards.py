"""Operator 7, sharding: a consistent-hash ring with bounded loads.

Keys fall into ``2**CELL_BITS`` cells of the ring by their hash.  A key with
more bytes than ``HEAVY`` of a shard (one id, or none, that many rows share)
is no unit under the law: its rows are keyed by id, text and a running number
and fall into as many cells as rows.  One grouped aggregation gives each cell's bytes and rows; this histogram has a fixed upper
size (65,536 rows), whatever the data, so the driver can walk the ring: a cell
goes clockwise from its position to the first virtual node whose shard still
has room under the bound ``(1 + SLACK) * total / shards``.  Large cells are
walked first, so the small ones fill what is left.  Rows then join their
cell's shard.  The slot of a row is its cell's start plus its rank inside the
cell, so no task ever holds a shard.

Law: ``bytes`` (no shard over the bound; moving to one more shard keeps most
keys, see ``placement`` and its tests).

Defined results: a null text has 0 bytes (size 8) and crc 0; a null doc_id is
one more key; repeated rows get slots of their own; a row larger than a
shard's bound fills the emptiest shard; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, table

SHARDS = 24
VIRTUAL_NODES = 128
CELL_BITS = 16
SLACK = 0.002
ROW_BYTES = 8
HEAVY = 0.0005  # of a shard's bytes: a key beyond it is spread


def _point(name: str) -> int:
    return int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big")


def ring(shards: int, replicas: int = VIRTUAL_NODES) -> tuple[list[int], list[int]]:
    """Sorted ring positions of all virtual nodes and their shards."""
    nodes = sorted((_point(f"shard-{s}/{r}"), s) for s in range(shards) for r in range(replicas))
    return [p for p, _ in nodes], [s for _, s in nodes]


def placement(cells: list[tuple[int, int]], shards: int, slack: float = SLACK,
              bits: int = CELL_BITS) -> tuple[dict[int, int], list[int]]:
    """Shard of each (cell, bytes), and the shards' loads."""
    points, owner = ring(shards)
    total = sum(size for _, size in cells)
    bound = (1 + slack) * total / shards
    loads, out = [0] * shards, {}
    for cell, size in sorted(cells, key=lambda c: (-c[1], c[0])):
        at = bisect.bisect_left(points, cell << (64 - bits))
        tried: set[int] = set()
        choice = None
        for k in range(len(points)):
            s = owner[(at + k) % len(points)]
            if s in tried:
                continue
            if loads[s] + size <= bound:
                choice = s
                break
            tried.add(s)
            if len(tried) == shards:
                break
        if choice is None:  # larger than every gap left: the emptiest shard takes it
            choice = min(range(shards), key=lambda s: (loads[s], s))
        out[cell] = choice
        loads[choice] += size
    return out, loads


def shard(docs: DataFrame, shards: int = SHARDS, slack: float = SLACK) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row of (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                             F.monotonically_increasing_id().alias("number")), "op7-rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # few keys can be this heavy: at most shards / HEAVY of them
    heavy = rows.groupBy("doc_id").agg(F.sum("size").alias("bytes"), F.count("*").alias("k")).filter(
        (F.col("bytes") > F.lit(HEAVY * total / shards)) & (F.col("k") > 1)).select(F.col("doc_id").alias("__id"), F.lit(True).alias("heavy"))
    known = rows.join(F.broadcast(heavy), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    key = F.when(F.col("heavy"), F.xxhash64("doc_id", "text_crc32", "number")).otherwise(F.xxhash64("doc_id"))
    keyed = stage(known.select("doc_id", "size", "text_crc32", "number", F.shiftrightunsigned(key, 64 - CELL_BITS).cast("int").alias("cell")), "op7-cells")
    hist = keyed.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    where, _ = placement([(r["cell"], r["bytes"]) for r in hist], shards, slack)
    filled, starts = [0] * shards, []
    for cell, rows in sorted((r["cell"], r["rows"]) for r in hist):
        s = where[cell]
        starts.append((cell, s, filled[s]))
        filled[s] += rows
    plan = spark.createDataFrame(starts, "cell int, shard int, start long")
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size", "number"))
    # at most 2**CELL_BITS rows of 16 bytes: the bound that makes this broadcast safe
    placed = keyed.withColumn("rank", rank).join(F.broadcast(plan), "cell")
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - 1).alias("slot"))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards of near equal bytes by a bounded-load ring."""
    placed = shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op7_shard": op7_shard}
ORACLES: dict = {}
