"""Best-fit packing: a configuration linear program over the length histogram, multiplicative weights, knapsack pricing, rounding.

Texts become pieces of at most ``capacity`` tokens. Only the histogram of lengths (at most ``capacity``
rows) reaches the driver. There, a configuration is a multiset of lengths that fits a sequence; the
program asks for the fewest sequences that cover the histogram. Its fractional solution is built by
multiplicative weights: each step prices the lengths by a weight and by how much of them is not covered
yet, finds the best configuration exactly (knapsack by dynamic programming over the capacity) and runs
it up to its scarcest length, until all are covered; weights start as sizes and grow over phases where sequences
have room. The solution is rounded down; what that leaves (less than one sequence of each configuration) is packed largest first,
each time with the largest length that fits, again by whole patterns, so the plan's size depends on the
number of lengths and not on the number of pieces. Pieces take their places in the plan by their rank
among the pieces of their length; ranks come from salted counts, so no length is one task.

Defined cases: a null or empty text is the end id alone; special tokens of the vocabulary that stand in a text are
taken as the tokenizer takes them, as their ids; an empty table gives an empty result; rows
that repeat a doc_id give pieces like others; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solidspark.llm.common import WORD, as_long, as_text, stage

END_ID = 0
#: Times that prices are set anew where a plan is not near its lower bound.
PHASES = 8
ROWS_PER_SALT = 100_000
#: Splits words in a batch that are encoded in one call; words that hold it are encoded alone.
MARK = "\x7f"
#: What may follow a word without being part of it; not the apostrophe, which starts contractions.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_RANK = 50
WORDS = re.compile(WORD)


class WordEncoder:
    """Ids of texts by a tokenizer that never merges across white space: each distinct word is encoded
    once and remembered, up to a bound."""

    def __init__(self, vocabulary: str, most: int = 900_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.seen = Tokenizer.from_file(vocabulary), most, {}
        #: Tokens that the tokenizer cuts out of a text wherever they stand, also inside a word.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = np.array(self._ids(MARK), "<u4")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _encode(self, words: list[str]) -> None:
        odd = [w for w in words if MARK in w or any(a in w for a in self.added)]
        for w in odd:
            self.seen[w] = np.array(self._ids(w), "<u4").tobytes()
        if odd:
            words = [w for w in words if w not in self.seen]
        if not words:
            return
        ids = np.array(self._ids(f" {MARK} ".join(words)), "<u4")
        at = np.flatnonzero(ids == self.mark[0])
        for j in range(1, len(self.mark)):
            at = at[ids[np.minimum(at + j, len(ids) - 1)] == self.mark[j]]
        if len(at) != len(words) - 1:  # never seen; the slow way is always right
            for w in words:
                self.seen[w] = np.array(self._ids(w), "<u4").tobytes()
            return
        raw, begin, k = ids.tobytes(), 0, len(self.mark)
        for w, end in zip(words, [*at.tolist(), len(ids)], strict=True):
            self.seen[w] = raw[4 * begin : 4 * end]
            begin = end + k

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        seen = self.seen
        # four control characters are white space to split() alone
        split = [WORDS.findall(t) if any(c in t for c in "\x1c\x1d\x1e\x1f") else t.split() for t in texts]
        if len(seen) > self.most:
            seen.clear()
        new = set().union(*split).difference(seen)
        stems = {}
        for w in new:  # a plain (Latin) word and the marks after it are tokens apart, so they are encoded apart
            stem = w.rstrip(MARKS)
            low = stem.lower()
            if any(a in w for a in self.added):
                continue
            if low != w and low.isalpha() and (w.isascii() or max(w) < "\u0130"):
                stems[w] = (low, w[len(stem) :])
        need = (new - stems.keys()) | {s for s, _ in stems.values()} | {e for _, e in stems.values() if e}
        self._encode([w for w in need if w not in seen])
        for w, (stem, end) in stems.items():
            seen[w] = seen[stem] + (seen[end] if end else b"")
        get = seen.__getitem__
        return [b"".join(map(get, ws)) for ws in split]


#: Of this Python worker, by vocabulary: what it remembers serves all its tasks.
_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(vocabulary: str) -> WordEncoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def _pieces(vocabulary: str, capacity: int, keep_ids: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(vocabulary)
        for frame in frames:
            for low in range(0, len(frame), 500):
                part, out = frame.iloc[low : low + 500], []
                for doc_id, ids in zip(part["doc_id"], encoder.encode([t or "" for t in part["text"]]), strict=True):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[a : a + 4 * capacity]
                        out.append((doc_id, k, a // 4, len(own) // 4, zlib.crc32(own), np.frombuffer(own, "<u4").astype("int64").tolist() if keep_ids else None))
                cols = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pd.DataFrame(out, columns=cols)[cols if keep_ids else cols[:-1]]

    return pieces


def best_configuration(values: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """Index -> copies of the multiset of lengths that fits and is worth most (unbounded knapsack)."""
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(int(lengths[0]), capacity + 1):
        n = upto[c]
        gain = best[c - lengths[:n]]
        gain += values[:n]
        k = int(gain.argmax())
        if gain[k] > best[c - 1]:
            best[c], took[c] = gain[k], k
        else:
            best[c] = best[c - 1]
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            k = int(took[c])
            out[k] = out.get(k, 0) + 1
            c -= int(lengths[k])
    return out


def fractional_cover(lengths: np.ndarray, counts: np.ndarray, capacity: int, prices: np.ndarray) -> list[tuple[dict[int, int], float]]:
    """Configurations and how often each runs, fractionally; covers every length, none twice. prices: of the lengths.

    A step runs its configuration up to its scarcest length, so there are no more steps than lengths."""
    need, out = counts.astype(float), []
    while len(active := np.flatnonzero(need > 1e-6 * counts)):
        # weights: multiplied down as a length is covered; size keeps configurations full
        weight = prices[active] * np.exp(0.2 * (need[active] / counts[active] - 1))
        found = best_configuration(weight, lengths[active], capacity)
        config = {int(active[k]): n for k, n in found.items()}
        run = min(need[k] / n for k, n in config.items())
        for k, n in config.items():
            need[k] = 0.0 if need[k] <= run * n * (1 + 1e-12) else need[k] - run * n
        out.append((config, run))
    return out


def _once(lengths: np.ndarray, counts: np.ndarray, capacity: int, prices: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> copies) and whole numbers of sequences: the fractional cover at these prices, rounded
    down, and what that leaves, largest first."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def run(config: dict[int, int], most: int | None = None) -> None:
        n = min(int(left[k]) // m for k, m in config.items())
        n = n if most is None else min(n, most)
        if n:
            for k, m in config.items():
                left[k] -= n * m
            out.append(({int(lengths[k]): m for k, m in config.items()}, int(n)))

    for config, often in fractional_cover(lengths, counts, capacity, prices):
        run(config, int(often + 1e-9))
    while left.any():
        config, room = {}, capacity
        for k in np.flatnonzero(left)[::-1]:
            if room < lengths[0]:
                break
            m = min(int(room // lengths[k]), int(left[k]))
            if m:
                config[int(k)] = m
                room -= m * int(lengths[k])
        run(config)
    return out


def plan(lengths: np.ndarray, counts: np.ndarray, capacity: int, phases: int = PHASES) -> list[tuple[dict[int, int], int]]:
    """Patterns and whole numbers of sequences that hold every piece exactly once.

    The prices of lengths are multiplicative weights over phases: a length whose sequences have room left is
    worth more in the next phase. The best phase counts; one that is within 0.2 % of a lower bound ends it."""
    if not len(lengths):
        return []
    whole = lengths == capacity
    out = [({int(capacity): 1}, int(counts[whole].sum()))] if whole.any() else []
    lengths, counts = lengths[~whole], counts[~whole]
    if not len(lengths):
        return out
    least = max(-(-int((lengths * counts).sum()) // capacity), int(counts[2 * lengths > capacity].sum()))
    prices, best, fewest = lengths * (1 + lengths / (20 * capacity)), None, math.inf
    for _ in range(phases):
        found = _once(lengths, counts, capacity, prices)
        n = sum(x for _, x in found)
        if n < fewest:
            best, fewest = found, n
        if fewest <= 1.002 * least + 0.5:
            break
        room = np.zeros(capacity)
        for config, x in found:
            waste = 1 - sum(a * m for a, m in config.items()) / capacity
            for a, m in config.items():
                room[a] += x * m * waste
        share = room[lengths] / counts
        prices = prices * np.exp(share / max(share.max(), 1e-9))
    return out + best


def _ranges(patterns: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (key of length and first rank, first sequence, sequences, offset), by key: where each rank goes."""
    rows, rank, base = [], {}, 0
    for config, n in patterns:
        offset = 0
        for length in sorted(config, reverse=True):
            rows.append(((length << _RANK) + rank.get(length, 0), base, n, offset))
            rank[length] = rank.get(length, 0) + n * config[length]
            offset += length * config[length]
        base += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset): every piece and its place."""
    texts = docs.select(as_text(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + (", ids array<long>" if keep_ids else "")
    pieces = stage(as_long(texts.mapInPandas(_pieces(vocabulary, capacity, keep_ids), schema), "doc_id"), "pack-pieces")
    histogram = sorted((r.length, r.n) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect())
    lengths, counts = np.array([x for x, _ in histogram], np.int64), np.array([n for _, n in histogram], np.int64)
    ranges = docs.sparkSession.sparkContext.broadcast(_ranges(plan(lengths, counts, capacity) if len(lengths) else []))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(1, -(-int(counts.sum()) // ROWS_PER_SALT)))))
    ahead = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own") - 1).drop("salt", "own", "before")

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = ranges.value
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            row = table[np.searchsorted(table[:, 0], (length << _RANK) + rank, "right") - 1]
            in_range = (length << _RANK) + rank - row[:, 0]
            out = frame.drop(columns="rank")
            out["sequence_id"] = row[:, 1] + in_range % row[:, 2]
            out["offset"] = row[:, 3] + in_range // row[:, 2] * length
            yield out[[c.split()[0] for c in schema.split(", ")] + ["sequence_id", "offset"]]

    return as_long(ranked.withColumn("doc_id", as_text("doc_id")).mapInPandas(place, schema + ", sequence_id long, offset long"), "doc_id")
