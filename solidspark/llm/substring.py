"""Substring dedup: sliding spans of sentences, joined globally; sentences under any non-first repeated span go.

A span is a run of several consecutive sentences, whatever its length (or with at least ``min_chars`` characters), or one long sentence.
All spans are compared, though only some are hashed: those that hold no shorter span with the same start, and those
that hold none with the same end. A span that is repeated is covered by the hashed ones inside it, which are repeated
with it: each of its sentences is in the one that starts there, or else in the one that ends with the span.

See :mod:`solidspark.llm.repeats` for nulls, ties, short and repeated rows. A text of white space alone has no
sentences and stays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.llm.repeats import cleaned, drop_repeats

#: A sentence ends after . ! or ? with white space, or after a line's end; the white space that follows stays with it.
SENTENCE = r"(?s)[\x20\x09-\x0D]*[^\x20\x09-\x0D].*?(?:[.!?][\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*|\z)"
#: Least characters of several sentences joined by one character each (at most what one sentence needs); 0: every run of two.
MIN_CHARS = 0
#: One sentence is a span with so many characters, or with more than so many words.
ALONE_CHARS, ALONE_WORDS = 300, 50


def spans(units: list[str], min_chars: int = MIN_CHARS, alone_chars: int = ALONE_CHARS, alone_words: int = ALONE_WORDS) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, longer ends): the shortest span from each start, and the spans from there that are the shortest to end where they do."""
    upto, least = [0, *accumulate(len(u) + 1 for u in units)], min(min_chars, alone_chars, 2 * alone_words)
    alone = [len(u) >= alone_chars or (len(u) >= 2 * alone_words and len(u.split()) > alone_words) for u in units]
    n, end, ends = len(units), 0, []
    for i in range(n):
        end = max(end, i + 1)
        while end <= n and not (alone[i] if end == i + 1 else upto[end] - upto[i] > least):
            end += 1
        if end > n:
            break
        ends.append(end)
    for i, end in enumerate(ends):
        yield i, end, list(range(end + 1, ends[i + 1] if i + 1 < len(ends) else n + 1))


def _key(units: list[str]) -> bytes:
    return hashlib.md5("\n".join(units).encode()).digest()[:12]


def dedup_spans(docs: DataFrame, min_chars: int = MIN_CHARS, alone_chars: int = ALONE_CHARS, alone_words: int = ALONE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` with the text cleaned, then ``n_sentences``, ``removed`` (0-based sentence numbers).

    With ``min_chars`` 0, as it is by default, every two consecutive sentences that occur together elsewhere earlier go."""

    @F.arrow_udf("array<struct<pos int, len int, key binary, more array<struct<len int, key binary>>>>")
    def runs_of(texts: pa.Array) -> pa.Array:
        offsets, pos, lens, keys, more_offsets, more_lens, more_keys = [0], [], [], [], [0], [], []
        for text in texts:
            units = text.as_py() or []
            for i, end, longer in spans(units, min_chars, alone_chars, alone_words):
                pos.append(i)
                lens.append(end - i)
                keys.append(_key(units[i:end]))
                more_lens.extend(j - i for j in longer)
                more_keys.extend(_key(units[i:j]) for j in longer)
                more_offsets.append(len(more_lens))
            offsets.append(len(pos))
        ints = lambda x: pa.array(x, pa.int32())
        more = pa.ListArray.from_arrays(ints(more_offsets), pa.StructArray.from_arrays([ints(more_lens), pa.array(more_keys, pa.binary())], ["len", "key"]))
        return pa.ListArray.from_arrays(ints(offsets), pa.StructArray.from_arrays([ints(pos), ints(lens), pa.array(keys, pa.binary()), more], ["pos", "len", "key", "more"]))

    def runs(units: DataFrame) -> DataFrame:
        # outer: a filter that Spark infers for a plain explode would need the runs twice
        rows = units.select("_id", "_th", runs_of("_units").alias("_all")).select("_id", "_th", F.explode_outer("_all").alias("_run")).where(F.col("_run").isNotNull())
        return rows.select("_id", "_th", *[F.col(f"_run.{c}").alias(f"_{c}") for c in ("pos", "len", "key", "more")])

    units = F.regexp_extract_all("_text", F.lit(SENTENCE), F.lit(0))
    none = F.size(units) == 0
    found = drop_repeats(docs, F.when(~none, units), "", runs, True, id_col, text_col)
    return cleaned(docs, found, text_col, "n_sentences")
