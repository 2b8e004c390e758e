"""Document fingerprints: SimHash. Weighted hashes of words vote on 128 signed bits; permuted block
tables find all fingerprints within a Hamming radius.

A term is a word in ASCII lower case; its weight grows with the logarithm of its count, rounded to
whole sixteenths, so that sums are exact and equal texts have equal fingerprints everywhere.

Search: a fingerprint is cut into ``blocks`` parts. Two within ``radius`` differ in at most that many
parts, so they agree in every part of at least one choice of ``blocks - radius`` parts: there is one
table for each choice, keyed by those parts. The radius of 6 in 128 bits is the share of bits that 3 of 64 are.

Edited texts need the next document in order of doc_id. Texts are dealt once, by ranges of doc_id, and sorted
there; a task reads its range as a stream and holds one batch. What it cannot finish, its last row, and its first row,
which another range needs, are written with their texts, and a second small step finishes the last rows.

Defined cases: a null text is an empty one, whose fingerprint is all zeros; after the last document
comes the first, so a single one follows itself; null doc_ids come first; rows that repeat a doc_id are
ordered by a hash of their text, then by text; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solidspark.llm.common import as_long, as_text, lower_words, stage, unstage
from solidspark.skew import shuffled

BITS = 128
#: Radius of the search, and the blocks of its tables.
RADIUS, BLOCKS = 6, 8
#: Bytes of text in a range of documents, about, up to so many ranges; beyond them ranges grow up to the larger size.
RANGE_BYTES, RANGES, LARGE_RANGE_BYTES = 16_000_000, 4096, 256_000_000


class Voter:
    """Fingerprints of texts; remembers the signs of words, up to a bound."""

    def __init__(self, most: int = 150_000):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.row: dict[bytes, int] = {}
        self.signs = np.empty((1024, BITS), np.int8)

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.row]
        if not new:
            return
        n = len(self.row)
        if n + len(new) > len(self.signs):
            self.signs = np.concatenate([self.signs, np.empty((max(len(self.signs), len(new)), BITS), np.int8)])
        raw = b"".join(xxhash.xxh3_128_digest(w) for w in new)
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(len(new), BITS // 8), axis=1)
        self.signs[n : n + len(new)] = bits.view(np.int8) * 2 - 1
        self.row.update(zip(new, range(n, n + len(new)), strict=True))

    def fingerprint(self, text: str) -> bytes:
        words = lower_words(text)
        if len(self.row) > self.most:
            self._clear()
        self._learn(set(words))
        if not words:
            return bytes(BITS // 8)
        own = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
        own.sort()
        at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        counts = np.diff(np.r_[at, len(own)])
        weights = np.rint(16 * (1 + np.log(counts)))
        exact = np.float32 if weights.sum() < 2**24 else np.float64
        votes = np.zeros(BITS, np.float64)
        for low in range(0, len(at), 8192):
            votes += weights[low : low + 8192].astype(exact) @ self.signs[own[at[low : low + 8192]]].astype(exact)
        return np.packbits(votes > 0).tobytes()


#: Of this Python worker: what it remembers serves all its ranges.
_VOTERS: list[Voter] = []


def _voter() -> Voter:
    if not _VOTERS:
        _VOTERS.append(Voter())
    return _VOTERS[0]


def _likeness(a: bytes, b: bytes) -> float:
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


PRINTS = "doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, hi long, lo long"
#: A row of a range: its prints, or (kind 1, the first, and 2, the last) its text.
ROWS = f"{PRINTS}, part int, kind int, text string"


def _row(doc_id: str | None, text: str, nxt: str, own: bytes, after: bytes) -> tuple:
    """The prints of a document and the next."""
    n = len(text)
    half = n // 2
    edited = text[: n - half] + nxt[:half]
    e = _voter().fingerprint(edited)
    signed = [int.from_bytes(own[k : k + 8], signed=True) for k in (0, 8)]
    return (doc_id, n, hashlib.sha256(edited.encode("utf-8")).hexdigest(), own.hex(), e.hex(), _likeness(own, e), _likeness(own, after), *signed)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    kinds = {"long": "Int64", "int": "Int32", "string": object, "double": "Float64"}
    columns = [c.split() for c in schema.split(", ")]
    return pd.DataFrame({name: pd.Series(values, dtype=kinds[kind]) for (name, kind), values in zip(columns, zip(*rows, strict=True), strict=True)})


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A sorted range: the prints of all but its last row, and the texts at its ends."""
    part, before, blank = TaskContext.get().partitionId(), None, (None,) * len(PRINTS.split(", "))
    for frame in frames:
        out = []
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            own = _voter().fingerprint(text)
            if before is None:
                out.append((doc_id, *blank[1:], part, 1, text))
            else:
                out.append((*_row(before[0], before[1], text, before[2], own), part, 0, None))
            before = (doc_id, text, own)
        if out:
            yield _frame(out, ROWS)
    if before is not None:
        yield _frame([(before[0], *blank[1:], part, 2, before[1])], ROWS)


def _ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [_row(d, t, n, _voter().fingerprint(t), _voter().fingerprint(n)) for d, t, n in zip(frame["doc_id"], frame["text"], frame["next"], strict=True)]
        if rows:
            yield _frame(rows, PRINTS)


def _prints(docs: DataFrame) -> DataFrame:
    """The prints of every row (doc_id, text)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, min(-(-size // RANGE_BYTES), max(RANGES, -(-size // LARGE_RANGE_BYTES))))
    dealt = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(ranges, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    rows = stage(dealt.select(as_text("doc_id").alias("doc_id"), "text").mapInPandas(_stream, ROWS), "simhash-ranges")
    parts = rows.where("kind = 1").select("part")
    # one number for each range: the only unpartitioned window; the last is followed by the first
    order = Window.orderBy("part")
    follows = parts.select("part", F.lead("part").over(order).alias("then")).join(F.broadcast(parts.agg(F.min("part").alias("least")))).select("part", F.coalesce("then", "least").alias("then"))
    first = rows.where("kind = 1").select(F.col("part").alias("then"), F.col("text").alias("next"))
    last = rows.where("kind = 2").select("part", "doc_id", "text").join(follows, "part").join(first, "then")
    names = [c.split()[0] for c in PRINTS.split(", ")]
    return as_long(rows.where("kind = 0").select(*names).unionByName(last.select("doc_id", "text", "next").mapInPandas(_ends, PRINTS)), "doc_id")


def _block(block: int, blocks: int, hi: Column, lo: Column) -> Column:
    """The bits of a block, of two longs; blocks do not cross the middle."""
    each = BITS // blocks
    half = BITS // 2
    word, at = (hi, block * each) if block * each < half else (lo, block * each - half)
    return F.shiftrightunsigned(word, half - at - each).bitwiseAND(F.lit((1 << each) - 1))


def hamming(hi: Column, lo: Column, hi2: Column, lo2: Column) -> Column:
    return F.bit_count(hi.bitwiseXOR(hi2)) + F.bit_count(lo.bitwiseXOR(lo2))


def near_pairs(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q_hi, q_lo, hi, lo, distance) of every pair of distinct fingerprints of the two tables within ``radius``.

    Tables hold distinct fingerprints as two longs, ``hi`` and ``lo``; ``blocks`` divides 64. Keys of the C(blocks, radius) tables
    have (blocks - radius) / blocks of all bits, so chance meetings are rare at any size."""
    choices = list(combinations(range(blocks), blocks - radius))
    keys = lambda hi, lo: F.array(*[F.xxhash64(F.lit(k), *[_block(b, blocks, hi, lo) for b in c]) for k, c in enumerate(choices)])
    q = queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo"), F.explode(keys(F.col("hi"), F.col("lo"))).alias("key"))
    f = index.select("hi", "lo", F.explode(keys(F.col("hi"), F.col("lo"))).alias("key"))
    distance = hamming(F.col("q_hi"), F.col("q_lo"), F.col("hi"), F.col("lo")).cast("int")
    return q.join(shuffled(f), "key").where(distance <= radius).select("q_hi", "q_lo", "hi", "lo", distance.alias("distance")).distinct()


def fingerprints(docs: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near).

    Likeness is the share of equal bits. n_near: for documents whose id is divisible by 100, how many
    other documents have a fingerprint within ``radius``; else null."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = stage(_prints(texts), "simhash-rows")
    asked = F.col("doc_id") % 100 == 0
    classes = rows.groupBy("hi", "lo").agg(F.count("*").alias("docs"), F.max(F.coalesce(asked, F.lit(False))).alias("asked"))
    classes = stage(classes, "simhash-classes")
    near = near_pairs(classes.where("asked"), classes, radius, blocks)
    n_near = near.join(shuffled(classes), ["hi", "lo"]).groupBy("q_hi", "q_lo").agg((F.sum("docs") - 1).alias("n_near"))
    n_near = stage(n_near.withColumnsRenamed({"q_hi": "hi", "q_lo": "lo"}), "simhash-near")
    unstage(classes)
    out = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    found = rows.where(asked).join(n_near, ["hi", "lo"]).select(*out, "n_near")
    return found.unionByName(rows.where(~F.coalesce(asked, F.lit(False))).select(*out, F.lit(None).cast("long").alias("n_near")))
