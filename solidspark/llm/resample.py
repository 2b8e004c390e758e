"""Importance resampling towards a target distribution: array-scored weights, sorted runs, tournament trees.

Every run of 1 to 2 consecutive words of a text is a feature and falls into a bucket (crc32). The counts of the buckets
over all documents and over all target texts give each bucket a gain; a document's weight is the floored mean of the
gains of its features, looked up in one array of fixed size (``buckets`` numbers, the only thing that is broadcast). Weight plus Gumbel noise
of the id is the score, and the highest scores of the eligible documents are drawn, without replacement.

The draw is an external merge. Counts of the (integer) scores give the exact number of draws and cut the scores
into ranges; what lies below the last drawn score never moves. Each partition sorts its eligible rows into runs of ``RUN_ROWS``,
cut into blocks that stay within one range. Blocks are shuffled to (range, group of ``WAYS`` runs) and read in the order of their
first keys, so a tournament tree of ``WAYS`` leaves merges each group as a stream with at most one open block a run; levels of trees
go on until a range is one run. A range's ranks begin where the counts of the higher scores end, and the tree of the
last range stops at the exact number of draws. No task sees more than a range, none holds more than ``WAYS`` blocks.

Defined cases: a null or empty text, or one without words, has no features and weight 0, and is not eligible; a null doc_id
is hashed as the empty string and loses ties; rows that repeat a doc_id are drawn one by one, ties by fewer features; an empty target
or an empty table of documents gives gains and results by the same formulas; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import stage, stage_frames, unstage

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Rows that a partition sorts at once; rows of a block; runs that one tree merges; rows of a range, about.
RUN_ROWS, BLOCK_ROWS, WAYS, RANGE_ROWS = 65_536, 512, 64, 100_000
#: Words whose features are taken at once.
AT_ONCE = 200_000
#: Longest word whose pairs are combined by tables.
_MOST = 64
#: Lower case for A-Z; what is neither a digit, a letter nor beyond ASCII parts words.
_TO = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO).split() if text else []


def _zero_bytes() -> np.ndarray:
    """[n, k, v]: what n more zero bytes make of a CRC register that holds v in its byte k."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = np.where(register & 1, (register >> 1) ^ np.uint32(0xEDB88320), register >> 1)
    out = np.empty((_MOST + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, _MOST + 1):
        out[n] = register[out[n - 1] & 255] ^ (out[n - 1] >> np.uint32(8))
    return out


class Features:
    """Buckets of the features of texts; remembers the CRCs of words, up to a bound."""

    def __init__(self, buckets: int, most: int = 300_000):
        self.buckets, self.most = buckets, most
        self.seen: dict[bytes, int] = {}
        self.after = _zero_bytes().ravel()

    def _shifted(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = n * 1024
        take = self.after.take
        return take(at + (crc & 255)) ^ take(at + 256 + ((crc >> 8) & 255)) ^ take(at + 512 + ((crc >> 16) & 255)) ^ take(at + 768 + (crc >> 24))

    def _codes(self, words: list[bytes]) -> np.ndarray:
        """CRC and, above it, the length of each word."""
        if len(self.seen) > self.most:
            self.seen.clear()
        seen = self.seen
        for w in set(words).difference(seen):
            seen[w] = zlib.crc32(w) | len(w) << 32
        return np.fromiter(map(seen.__getitem__, words), np.int64, len(words))

    def _flush(self, words: list[bytes], owner: np.ndarray, ghost: bool) -> tuple[np.ndarray, np.ndarray]:
        codes = self._codes(words)
        crc, n = codes & 0xFFFFFFFF, codes >> 32
        both = np.flatnonzero(owner[1:] == owner[:-1])
        # one byte more is one step of the register, with its usual turning over before and after
        spaced = self._shifted(crc[both], np.ones(len(both), np.int64)).astype(np.int64) ^ zlib.crc32(b" ")
        last = both + 1
        pairs = self._shifted(spaced, np.minimum(n[last], _MOST)).astype(np.int64) ^ crc[last]
        for k in np.flatnonzero(n[last] > _MOST):
            pairs[k] = zlib.crc32(words[last[k]], int(spaced[k]))
        first = int(ghost)
        return np.concatenate([owner[first:], owner[last]]), np.concatenate([crc[first:], pairs]) % self.buckets

    def of(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(index of text, bucket) of features, and the numbers of words of texts, in portions of about AT_ONCE words."""
        words: list[bytes] = []
        owners: list[tuple[int, int]] = []
        ghost = False

        def flush() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            owner = np.repeat(np.array([d for d, _ in owners], np.int64), [n for _, n in owners])
            return *self._flush(words, owner, ghost), np.bincount(owner[int(ghost) :], minlength=len(texts))

        for d, text in enumerate(texts):
            raw = text.encode().translate(_TO) if text else b""
            begin = 0
            while begin < len(raw):
                end = raw.find(b" ", begin + 6 * AT_ONCE)
                end = len(raw) if end < 0 else end
                found = raw[begin:end].split()
                begin = end
                words += found
                owners.append((d, len(found)))
                if len(words) >= AT_ONCE:
                    yield flush()
                    # the last word pairs with the next one of its text
                    words, owners, ghost = words[-1:], [(d, 1)], True
        if len(words) > ghost:
            yield flush()


def bucket_counts(texts: DataFrame, text_col: str, buckets: int) -> dict[int, int]:
    """Bucket -> number of features: at most ``buckets`` rows reach the driver, whatever the table's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features.of(batch.column(0).to_pylist()):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    parts = stage_frames(texts.select(text_col).mapInArrow(count, "bucket long, n long"), "rs-counts")
    found = {r.bucket: r.n for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    unstage(parts)
    return found


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    s, t = sum(source.values()), sum(target.values())
    gain = lambda b: math.floor(1000 * math.log(float(target.get(b, 0) + 1) * (s + buckets) / (float(source.get(b, 0) + 1) * (t + buckets))))
    return np.array([gain(b) for b in range(buckets)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, least_words: int, seed: int) -> DataFrame:
    """(doc_id, n_features, weight, score, eligible, part, pos); part and pos tell the rows of the staged table apart."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, part, pos = shared.value, TaskContext.get().partitionId(), 0
        features = Features(len(gain))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            total, n, words = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for owner, bucket, n_words in features.of(texts):
                total += np.bincount(owner, gain[bucket], len(ids)).astype(np.int64)  # sums far below 2**53 are exact
                n += np.bincount(owner, minlength=len(ids))
                words += n_words
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            own = weight + np.array([noise(i, seed) for i in ids], np.int64)
            columns = [batch.column(0), n, weight, own, words >= least_words, np.full(len(ids), part), pos + np.arange(len(ids))]
            pos += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], ["doc_id", "n_features", "weight", "score", "eligible", "part", "pos"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage_frames(rows.mapInArrow(score, "doc_id long, n_features long, weight long, score long, eligible boolean, part long, pos long"), "rs-scored")


def place() -> Column:
    """The order of the draw: higher scores, then smaller ids, then what tells equal ones apart."""
    return F.struct((-F.col("score")).alias("s"), F.col("doc_id").isNull().cast("long").alias("o"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("n_features").alias("f"), F.col("part").alias("p"), F.col("pos").alias("q"))


FIELDS = 7  # six of place() and the weight
_ROW = 8 * FIELDS


def _packed(fields: np.ndarray) -> np.ndarray:
    """Rows of whole numbers as bytes that sort as the rows do."""
    return (fields.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")


def _unpacked(raw: bytes) -> np.ndarray:
    return (np.frombuffer(raw, ">u8").astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64).reshape(-1, FIELDS)


class Tournament:
    """A winner tree over ``ways`` leaves, each a sorted block of packed rows or empty."""

    def __init__(self, ways: int):
        self.ways = 1 << max(0, ways - 1).bit_length()
        self.blocks: list[bytes] = [b""] * self.ways
        self.at = [0] * self.ways
        self.heads: list[bytes | None] = [None] * self.ways
        self.tree = [0] * self.ways  # the leaf that wins below each node, at first the leftmost; [1] is the root's
        for node in range(self.ways - 1, 0, -1):
            self.tree[node] = 2 * node - self.ways if 2 * node >= self.ways else self.tree[2 * node]

    def _play(self, leaf: int) -> None:
        node, heads, tree, ways = (leaf + self.ways) >> 1, self.heads, self.tree, self.ways
        while node:
            a, b = (2 * node - ways, 2 * node + 1 - ways) if 2 * node >= ways else (tree[2 * node], tree[2 * node + 1])
            x, y = heads[a], heads[b]
            tree[node] = a if y is None or (x is not None and x <= y) else b
            node >>= 1

    def enter(self, leaf: int, block: bytes) -> None:
        self.blocks[leaf], self.at[leaf], self.heads[leaf] = block, 0, block[:_ROW]
        self._play(leaf)

    def head(self) -> bytes | None:
        return self.heads[self.tree[1] if self.ways > 1 else 0]

    def pop(self) -> bytes:
        leaf = self.tree[1] if self.ways > 1 else 0
        won = self.heads[leaf]
        self.at[leaf] += _ROW
        self.heads[leaf] = self.blocks[leaf][self.at[leaf] : self.at[leaf] + _ROW] or None
        self._play(leaf)
        return won


def merged(blocks: Iterator[tuple[int, bytes]], ways: int, most: int) -> Iterator[bytes]:
    """The first ``most`` rows of runs in order. blocks: (run, block), by their first rows; a run's blocks in its order."""
    tree = Tournament(ways)
    for run, block in blocks:
        while most and (head := tree.head()) is not None and head < block[:_ROW]:
            yield tree.pop()
            most -= 1
        if not most:
            return
        tree.enter(run, block)
    while most and tree.head() is not None:
        yield tree.pop()
        most -= 1


_BLOCKS = "range long, run long, first binary, rows binary"


def _cut(range_id: int, run: int, rows: bytes) -> Iterator[tuple[int, int, bytes, bytes]]:
    for a in range(0, len(rows), BLOCK_ROWS * _ROW):
        block = rows[a : a + BLOCK_ROWS * _ROW]
        yield range_id, run, block[:_ROW], block


def _batch(found: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.binary(), pa.binary()
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["range", "run", "first", "rows"])


def _runs(rows: DataFrame, lows: np.ndarray, run_rows: int) -> DataFrame:
    """Blocks of sorted runs, as many runs a partition as ``run_rows`` make. lows: the least score of each range, descending.

    The k-th run of partition p has the number (k << 32) + p."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, n = TaskContext.get().partitionId(), 0, [], 0

        def run() -> Iterator[pa.RecordBatch]:
            fields = np.concatenate(held)
            fields = fields[np.lexsort(fields.T[5::-1])]
            in_range = np.searchsorted(-lows, fields[:, 0], "left")
            cuts = [0, *(np.flatnonzero(np.diff(in_range)) + 1).tolist(), len(fields)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                found = list(_cut(int(in_range[a]), (k << 32) + part, _packed(fields[a:b]).tobytes()))
                for c in range(0, len(found), 100):
                    yield _batch(found[c : c + 100])

        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(FIELDS)], 1))
                n += batch.num_rows
            if n >= run_rows:
                yield from run()
                held, n, k = [], 0, k + 1
        if n:
            yield from run()

    p = place()
    return rows.select(*[p.getField(c).alias(c) for c in "sodfpq"], "weight").mapInArrow(sort, _BLOCKS)


def _merge(blocks: DataFrame, limits: np.ndarray, ways: int) -> DataFrame:
    """One level of trees: the runs of each range in groups of ``ways``; a range gives at most its limit of rows."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        nxt = next(rows, None)
        while nxt is not None:
            key = (nxt[0], nxt[1] // ways)

            def group() -> Iterator[tuple[int, bytes]]:
                nonlocal nxt
                while nxt is not None and (nxt[0], nxt[1] // ways) == key:
                    now, nxt = nxt, next(rows, None)
                    yield now[1] % ways, now[3]

            own = group()
            held: list[bytes] = []
            for row in merged(own, ways, int(limits[key[0]])):
                held.append(row)
                if len(held) == 64 * BLOCK_ROWS:
                    yield _batch(list(_cut(*key, b"".join(held))))
                    held = []
            if held:
                yield _batch(list(_cut(*key, b"".join(held))))
            for _ in own:  # beyond the limit
                pass

    dealt = blocks.withColumn("grp", F.floor(F.col("run") / ways)).repartition("range", "grp").sortWithinPartitions("range", "grp", "first")
    return dealt.drop("grp").mapInArrow(merge, _BLOCKS)


def _ranked(blocks: DataFrame, offsets: np.ndarray) -> DataFrame:
    """Rows with ranks of the one run that each range has become. Its blocks are read in order."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: tuple[int, int] = (-1, 0)
        for batch in batches:
            for r, raw in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                rows, before = _unpacked(raw), done[1] if done[0] == r else 0
                done = (r, before + len(rows))
                ids = pa.array(rows[:, 2], mask=rows[:, 1] == 1)
                ranks = offsets[r] + before + 1 + np.arange(len(rows))
                columns = [ids, *(pa.array(np.ascontiguousarray(c)) for c in (rows[:, 3], rows[:, 6], -rows[:, 0], ranks, rows[:, 4], rows[:, 5]))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_features", "weight", "score", "rank", "part", "pos"])

    dealt = blocks.repartition("range").sortWithinPartitions("range", "first")
    return dealt.mapInArrow(rank, "doc_id long, n_features long, weight long, score long, rank long, part long, pos long")


def draw(rows: DataFrame, percent: int = PERCENT, run_rows: int = RUN_ROWS, range_rows: int = RANGE_ROWS, ways: int = WAYS) -> DataFrame:
    """``rows`` (of :func:`scored`) as (doc_id, n_features, weight, score, rank): the highest ``percent`` of the eligible ones have ranks."""
    eligible = rows.where("eligible")
    # whole scores: as many different ones as gains and noise have values, whatever the table's size
    counts = sorted(((r.score, r.n) for r in eligible.groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    want = percent * sum(n for _, n in counts) // 100
    plain = rows.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    if not want:
        return plain
    lows, sizes, offsets, upto = [], [], [], 0
    for score, n in counts:
        if upto >= want:
            break
        if not lows or sizes[-1] + n > range_rows:
            lows.append(score)
            sizes.append(0)
            offsets.append(upto)
        lows[-1] = score
        sizes[-1] += n
        upto += n
    limits = np.minimum(np.array(sizes), want - np.array(offsets))
    near = eligible.where(F.col("score") >= lows[-1])
    runs = stage_frames(_runs(near, np.array(lows), run_rows), "rs-runs", 10_000)
    k, part = F.shiftright("run", 32), F.col("run").bitwiseAND(0xFFFFFFFF)
    most = runs.agg(F.max(k).alias("k"), F.max(part).alias("part")).first()
    blocks, n_runs = runs.withColumn("run", k * (most.part + 1) + part), (most.k + 1) * (most.part + 1)
    while True:
        after = stage_frames(_merge(blocks, limits, ways), "rs-merged", 100)
        unstage(runs)
        runs = after
        blocks, n_runs = after, -(-n_runs // ways)
        if n_runs == 1:
            break
    drawn = stage_frames(_ranked(blocks, np.array(offsets)), "rs-drawn", 100)
    unstage(runs)
    last = drawn.where(F.col("rank") == want).select(place().alias("k")).first().k
    after_last = place() > F.struct(*[F.lit(last[c]).cast("long").alias(c) for c in "sodfpq"])
    rest = rows.where(~F.col("eligible") | after_last).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank").unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank: 1, 2, 3... of the drawn ones, else null."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets), buckets)
    return draw(scored(docs, gain, id_col, text_col, least_words, seed), percent)
