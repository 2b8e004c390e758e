"""Sum-of-squares online packing: every document goes to the fill level that keeps the squared counts of open windows least.

Texts become ids, then documents of ids, then pieces of at most ``capacity`` ids. Each task packs the
documents of its partition as they come, with no shuffle: a level array holds how many windows are open at each fill. A
piece of length s may move a window from any level h to h + s, or open one; the move that makes the sum of squared counts
least is taken (the fullest window on ties). A full window is written at once. Windows at a power of two need no
padding, so their levels count as empty in the sum, though their windows may still grow.

Where documents end, the open windows at other levels are settled: they are laid end to end and cut into full
windows, and what is left (less than one window a task) into powers of two. So nothing is padded, and few documents are cut.
The same is done with the most crowded level whenever more than ``MOST_OPEN`` windows are open, so a
task holds at most that many windows, whatever the lengths are (documents of 1,500 ids alone would leave one open each).

Defined cases: a null or empty text is the end id alone; special tokens of the vocabulary that stand in a text are taken as the
tokenizer takes them; an empty table gives an empty result; rows that repeat a doc_id, also a null one, give pieces like others;
other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import stage_frames

END_ID = 1
MOST_OPEN = 4096
#: How the byte-level tokenizer parts a text before it merges bytes (a fixed value of the vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space but blank and line feed.
OTHER_SPACE = "\t\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where these stand, a run of white space is parted by what follows it.
RUNS = ("  ", " \n", "\n ", "\n\n\n")
#: A piece: document (its number in the task), start, ids.
Piece = tuple[int, int, bytes]


def _bytes_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Remembered(dict):
    """Ids of parts of texts. A part begins with a line feed, or stands after a blank."""

    def __init__(self, vocabulary: dict[str, int]):
        import tiktoken

        of = _bytes_of()
        ranks = {bytes(map(of.__getitem__, token)): i for token, i in vocabulary.items()}
        self.ids, self.old = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, {}

    def __missing__(self, part: str) -> bytes:
        found = self.old.get(part)
        if found is None:
            found = array("I", self.ids(part if part[0] == "\n" else " " + part)).tobytes()
        self[part] = found
        return found

    def turn(self, most: int) -> None:
        """Of more than ``most`` parts, remember those that are met again before so many new ones are."""
        if len(self) > most:
            self.old = dict(self)
            self.clear()


class PartEncoder:
    """Ids of texts by a byte-level tokenizer, part by part: a blank or a line feed between other characters always begins a
    part that the tokenizer merges alone. Parts go through the vocabulary's merges once and are remembered; texts where
    white space stands otherwise, or that hold special tokens, go through the tokenizer whole."""

    def __init__(self, vocabulary: str, most: int = 700_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(vocabulary), most
        self.seen = Remembered(self.tokenizer.get_vocab(with_added_tokens=False))
        #: Tokens that the tokenizer cuts out of a text wherever they stand.
        self.odd = [*RUNS, *OTHER_SPACE, *(t.content for t in self.tokenizer.get_added_tokens_decoder().values())]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; null: none.

        A batch's parts are cut and told apart by Arrow, so that Python looks each different one up once."""
        self.seen.turn(self.most)
        out, plain = [b""] * len(texts), []
        for k, text in enumerate(texts.to_pylist()):
            if not text:
                continue
            if text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, self.odd)):
                out[k] = self.whole([text])[0]
            else:
                plain.append(k)
        if not plain:
            return out
        rows = pc.replace_substring(texts.take(pa.array(plain)), "\n", " \n")
        lists = pc.split_pattern(pc.binary_join_element_wise("\n", rows, ""), " ")
        parts = lists.flatten().dictionary_encode()
        each = list(map(self.seen.__getitem__, parts.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
        begins, which = np.cumsum(sizes) - sizes, parts.indices.to_numpy()
        n = sizes[which]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(begins[which] - (ends - n), n)
        raw = np.frombuffer(b"".join(each), "<u4")[at].tobytes()
        ends = 4 * np.r_[0, ends][lists.offsets.to_numpy()]
        for k, a, b in zip(plain, ends.tolist(), ends[1:].tolist(), strict=False):
            out[k] = raw[a + 4 : b]  # the line feed before the first part is one id
        return out


#: Of this Python worker, by vocabulary: what it remembers serves all its tasks.
_ENCODERS: dict[str, PartEncoder] = {}


def encoder_of(vocabulary: str) -> PartEncoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = PartEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def joined(windows: list[list[Piece]], sizes: list[int]) -> Iterator[list[Piece]]:
    """The pieces of ``windows`` laid end to end and cut where the windows of these sizes end."""
    pieces = [p for w in windows for p in w][::-1]
    for size in sizes:
        own, room = [], 4 * size
        while room:
            doc, start, ids = pieces.pop()
            if len(ids) > room:
                pieces.append((doc, start + room // 4, ids[room:]))
                ids = ids[:room]
            own.append((doc, start, ids))
            room -= len(ids)
        yield own


def powers(n: int) -> list[int]:
    """The powers of two that add up to n, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


class SumOfSquares:
    """The open windows of one stream of pieces, by level."""

    def __init__(self, capacity: int, most_open: int = MOST_OPEN):
        self.capacity, self.most_open, self.n_open = capacity, most_open, 0
        self.levels: list[list[list[Piece]]] = [[] for _ in range(capacity)]
        #: Whether windows at a level would be padded.
        self.counted = np.array([h > 0 and h & (h - 1) > 0 for h in range(capacity)] + [False])
        # what the sum gains when a window leaves a level (no window: never) and when one comes
        self.leave = np.full(capacity + 1, np.inf)
        self.leave[0] = 0.0
        self.come = self.counted.astype(float)

    def _count(self, h: int) -> None:
        n = len(self.levels[h])
        self.leave[h] = np.inf if not n else 1.0 - 2 * n if self.counted[h] else 0.0
        self.come[h] = 2.0 * n + 1 if self.counted[h] else 0.0

    def _put(self, h: int, window: list[Piece]) -> None:
        self.levels[h].append(window)
        self.n_open += 1
        self._count(h)

    def _take(self, h: int) -> list[Piece]:
        window = self.levels[h].pop()
        self.n_open -= 1
        self._count(h)
        return window

    def _take_all(self, h: int) -> list[list[Piece]]:
        windows, self.levels[h] = self.levels[h], []
        self.n_open -= len(windows)
        self._count(h)
        return windows

    def level_for(self, size: int) -> int:
        """The level whose window takes a piece of this size; 0: a new one."""
        most = self.capacity - size
        change = (self.leave[: most + 1] + self.come[size:])[::-1]
        return most - int(change.argmin())

    def place(self, piece: Piece) -> Iterator[list[Piece]]:
        """Windows that are done once the piece, shorter than a window, has its place."""
        size = len(piece[2]) // 4
        h = self.level_for(size)
        window = [*(self._take(h) if h else []), piece]
        if h + size == self.capacity:
            yield window
        else:
            self._put(h + size, window)
            if self.n_open > self.most_open:
                yield from self._relieve()

    def _relieve(self) -> Iterator[list[Piece]]:
        """Make full windows of the most crowded level, so that at most one of them stays open."""
        h = max(range(1, self.capacity), key=lambda x: len(self.levels[x]))
        windows = self._take_all(h)
        full, left = divmod(h * len(windows), self.capacity)
        cut = list(joined(windows, [self.capacity] * full + [left] * (left > 0)))
        yield from cut[:full]
        for window in cut[full:]:
            self._put(left, window)

    def settle(self) -> Iterator[list[Piece]]:
        """All windows that are still open, without padding."""
        rest, total = [], 0
        for h in range(1, self.capacity):
            windows = self._take_all(h)
            if self.counted[h]:
                rest += windows
                total += h * len(windows)
            else:
                yield from windows
        full, left = divmod(total, self.capacity)
        yield from joined(rest, [self.capacity] * full + powers(left))


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, keep_ids: bool = False, end_id: int = END_ID, most_open: int = MOST_OPEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, [ids]): every piece and its place. capacity: a power of two."""
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    kinds = {c: pa.int64() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    if keep_ids:
        kinds["ids"] = pa.list_(pa.int64())
    end = np.array([end_id], "<u4").tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, levels = encoder_of(vocabulary), SumOfSquares(capacity, most_open)
        sequence = TaskContext.get().partitionId() << 40
        #: (doc_id, ids) of the documents that still have pieces in open windows, and how many bytes of them are open.
        known: dict[int, list] = {}
        rows: list[tuple] = []

        def write(window: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids in window:
                own = known[doc]
                n = len(ids) // 4
                rows.append((own[0], start, n, zlib.crc32(ids), own[1], sequence, offset, *([np.frombuffer(ids, "<u4").tolist()] if keep_ids else [])))
                offset += n
                own[2] -= n
                if not own[2]:
                    del known[doc]
            sequence += 1

        def batch() -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))
            rows.clear()
            return out

        number = 0
        for frame in batches:
            for doc_id, ids in zip(frame.column(0).to_pylist(), encoder.encode(frame.column(1)), strict=True):
                ids += end
                n = len(ids) // 4
                known[number] = [doc_id, n, n]
                whole = n - n % capacity
                for a in range(0, whole, capacity):
                    write([(number, a, ids[4 * a : 4 * (a + capacity)])])
                if n > whole:
                    for window in levels.place((number, whole, ids[4 * whole :])):
                        write(window)
                number += 1
                if len(rows) >= 10_000:
                    yield batch()
        for window in levels.settle():
            write(window)
        yield batch()

    schema = ", ".join(f"{c} {'array<long>' if c == 'ids' else 'long'}" for c in kinds)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stage_frames(texts.mapInArrow(packed, schema), "ss-pieces", 1500)
