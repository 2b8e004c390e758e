"""Sharding: minimax contiguous partition of ordered atomic groups.

Native: DataFrame functions only. Groups (rows of equal text) are ordered by a hash of their text,
so any bucket of the order has its share of groups, whatever the input's order. The smallest shard
capacity is found by binary search with a greedy check, then the order is cut there.

The greedy check needs, for a place x, the last group end at or before x. The driver never holds all
ends: it holds a grid of at most ``CELLS`` cells, each with its first and last end, and searches with
a bound from below and one from above. Where the two disagree, only the cells that a cut may fall in
are divided again, by one aggregation over the ends. The answer is exact.

Defined cases: a null text counts as an empty one (size 1, crc32 0, one group with the empty texts);
an empty table gives an empty result; fewer groups than shards leave shards empty; one group larger
than its share is a shard's floor; rows that repeat a doc_id are rows like others; null doc_ids are
kept; other columns are not read.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solidspark.llm.common import stage

#: Cells of the search's grid: what the driver holds.
CELLS = 4096
#: Rows of one group that one task ranks, about.
ROWS_PER_SALT = 100_000


class _Ends:
    """Known group ends, and after which of them unknown ones may follow before the next."""

    def __init__(self, cells: list[tuple[int, int, int]]):
        self.known: list[int] = [0]
        self.open: list[bool] = [False]
        self.replace([], cells)

    def replace(self, ranges: list[tuple[int, int]], cells: list[tuple[int, int, int]]) -> None:
        kept = [(k, o) for k, o in zip(self.known, self.open, strict=True) if not any(a < k <= b for a, b in ranges)]
        kept = [(k, o and not any(a <= k < b for a, b in ranges)) for k, o in kept]
        for low, high, n in cells:
            kept.append((low, n > 2))
            if high > low:
                kept.append((high, False))
        kept.sort()
        self.known, self.open = [k for k, _ in kept], [o for _, o in kept]

    def least(self, x: int) -> int:
        return self.known[bisect.bisect_right(self.known, x) - 1]

    def most(self, x: int) -> int:
        i = bisect.bisect_right(self.known, x) - 1
        return x if self.open[i] else self.known[i]

    def around(self, low: int, high: int) -> tuple[int, int]:
        """The range widened to known ends."""
        i, j = bisect.bisect_right(self.known, low) - 1, bisect.bisect_left(self.known, high)
        return self.known[max(i, 0)], self.known[min(j, len(self.known) - 1)]

    def unknown(self, low: int, high: int) -> bool:
        i, j = bisect.bisect_left(self.known, low), bisect.bisect_left(self.known, high)
        return any(self.open[i:j])


def _chain(cap: int, n: int, total: int, last) -> list[int] | None:
    """Greedy cuts of shards of at most ``cap``; None if ``n`` are not enough."""
    at, cuts = 0, []
    for _ in range(n):
        if at + cap >= total:
            return cuts
        end = last(at + cap)
        if end <= at:
            return None
        cuts.append(end)
        at = end
    return None


def _smallest(low: int, high: int, n: int, total: int, last) -> int:
    while low < high:
        mid = (low + high) // 2
        if _chain(mid, n, total, last) is None:
            low = mid + 1
        else:
            high = mid
    return low


def minimax_cuts(ends: DataFrame, total: int, largest: int, n_shards: int, cells: int = CELLS) -> tuple[int, list[int]]:
    """(capacity, cuts): the smallest capacity with which ``n_shards`` contiguous shards hold all
    groups, and the group ends to cut after. ``ends`` has the cumulative sizes as ``end``."""

    def grid(ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        each = max(16, cells // len(ranges))
        cell, inside = F.lit(None).cast("long"), F.lit(False)
        for k, (a, b) in enumerate(ranges):  # ends in (a, b]
            width = max(1, -(-(b - a) // each))
            here = (F.col("end") > a) & (F.col("end") <= b)
            cell = F.when(here, F.floor((F.col("end") - (a + 1)) / F.lit(float(width))).cast("long") + k * (each + 1)).otherwise(cell)
            inside = inside | here
        found = ends.where(inside).groupBy(cell.alias("cell")).agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n")).collect()
        return [(r.a, r.b, r.n) for r in found]

    floor = max(largest, -(-total // n_shards))
    known = _Ends(grid([(0, total)]))
    while True:
        low = _smallest(floor, total, n_shards, total, known.most)
        high = _smallest(low, total, n_shards, total, known.least)
        if low == high:
            return high, _chain(high, n_shards, total, known.least)
        spans: list[tuple[int, int]] = []
        first = last = 0
        for _ in range(n_shards):
            a, b = known.around(min(first + low, total), min(last + high, total))
            if known.unknown(a, b):
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
                elif b > a:
                    spans.append((a, b))
            first, last = known.least(min(first + low, total)), known.most(min(last + high, total))
        known.replace(spans, grid(spans))


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; law ``bytes``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("g"),
    )
    n_rows = docs.count()
    salts = max(1, -(-n_rows // ROWS_PER_SALT))
    bits = min(16, max(6, (n_rows // ROWS_PER_SALT).bit_length()))
    rows = stage(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts))), "shard-rows")
    parts = rows.groupBy("h", "g", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    groups = parts.groupBy("h", "g").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    groups = groups.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    in_bucket = Window.partitionBy("bucket").orderBy("h", "g")
    # one row per bucket, at most 65,536: the only unpartitioned window
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.groupBy("bucket").agg(F.sum("n").alias("bn"), F.sum("bytes").alias("bb"))
    offsets = offsets.select("bucket", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("bb").over(before), F.lit(0)).alias("b0"))
    order = groups.select("h", "g", "bucket", "n", "bytes", F.sum("n").over(in_bucket).alias("cn"), F.sum("bytes").over(in_bucket).alias("cb"))
    order = stage(order.join(offsets, "bucket").select("h", "g", "n", "bytes", (F.col("n0") + F.col("cn")).alias("rows_end"), (F.col("b0") + F.col("cb")).alias("end")), "shard-order")
    total, largest = order.agg(F.max("end"), F.max("bytes")).first()
    cuts = minimax_cuts(order, total, largest, n_shards)[1] if total else []
    shard = sum([(F.col("end") > c).cast("int") for c in cuts], F.lit(0)).cast("int")
    starts = {r.shard: r.n0 for r in order.groupBy(shard.alias("shard")).agg(F.min(F.col("rows_end") - F.col("n")).alias("n0")).collect()}
    start = F.lit(0).cast("long")
    for k, n0 in starts.items():
        start = F.when(F.col("shard") == k, F.lit(n0)).otherwise(start)
    placed = order.select("h", "g", shard.alias("shard"), (F.col("rows_end") - F.col("n")).alias("first")).select("h", "g", "shard", (F.col("first") - start).alias("first"))
    ahead = Window.partitionBy("h", "g").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.join(placed, ["h", "g"]).select("h", "g", "salt", "shard", (F.col("first") + F.coalesce(F.sum("n").over(ahead), F.lit(0))).alias("first"))
    rank = F.row_number().over(Window.partitionBy("h", "g", "salt").orderBy("doc_id"))
    return rows.withColumn("rank", rank).join(placed, ["h", "g", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
