"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star edges.

A document's set is its distinct 5-word shingles (64-bit hashes of them). One hash of a shingle gives
both its bin and its rank in it; a bin without shingles takes the value of the bin that its own
sequence of probes meets first (optimal densification), so that two documents agree in a bin with the
probability of their Jaccard similarity, whatever their sizes. 32 bands of 4 bins: a pair at
similarity 0.75 shares no band with probability (1 - 0.75**4)**32 < 1e-5.

Texts with one set are one class and are compared once. In every bucket (band value) all members are
joined to the bucket's smallest document only: a star, linear in the bucket. The edges are confirmed
on whole sets. Where a bucket's members are then still in several components, the star may have missed a
link between two of them: those documents alone are compared again by prefix filtering, which misses no
pair at the wanted similarity (see ``_prefixes``). Documents that share a template but differ in words of their
own do not meet there: the words of their own come first and fill the prefix exactly as far as they keep a pair
below 0.75. Documents that are linked already do not meet either. What may still grow with the square of a group are documents whose rarer
shingles are common to many, in ever other mixtures.

Keys that may be very frequent (a band's value, a centre, a digest, a shingle) meet their one row by
:mod:`solidspark.skew`.

Defined cases: null or empty texts and texts without words have an empty set, are linked with nothing
and kept; fewer words than a shingle are one shingle; rows that repeat a doc_id are one node (where their texts differ, the links are confirmed on the
smallest text that is linked);
a row with a null doc_id is never a representative nor linked; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solidspark.llm.common import as_long, as_text, lower_words, stage, stage_frames, unstage
from solidspark.operators.components import smallest_reachable
from solidspark.skew import heavy_keys, join_heavy

BINS, ROWS, SHINGLE = 128, 4, 5
#: Members confirmed against one copy of their centre's set in one task.
CHUNK = 64
#: Sizes in one class of the residual search differ by less than this factor; documents in one of its arrays, about.
SIZE_STEP, MEMBERS = 1.05, 500
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of shingle hashes; remembers the hashes of words, up to a bound."""

    def __init__(self, most: int = 80_000):
        self.seen: dict[bytes, int] = {}
        self.most = most

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen.clear()
        seen = self.seen
        for w in set(words).difference(seen):
            seen[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes."""
        words = lower_words(text)
        if not words:
            return np.empty(0, np.uint64)
        h = self.hashes(words)
        k = min(SHINGLE, len(h))
        n = len(h) - k + 1
        acc = np.full(n, k, np.uint64)
        for j in range(k):
            acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n])
        return np.unique(acc)


@lru_cache(4096)
def _probes(attempt: int) -> np.ndarray:
    """Where each bin looks at its so-manyth attempt."""
    return (_mix(np.arange(BINS, dtype=np.uint64) * np.uint64(1_000_003) + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)


def signature(s: np.ndarray) -> np.ndarray:
    """The values of the bins, densified; ``s`` is sorted, so a bin's first shingle has its least rank."""
    bins = (s >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    sig, full = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    sig[bins[first]], full[bins[first]] = s[first], True
    empty, attempt = np.flatnonzero(~full), 0
    while len(empty):
        attempt += 1
        to = _probes(attempt)[empty]
        hit = full[to]
        sig[empty[hit]] = sig[to[hit]]
        empty = empty[~hit]
    return sig


def bands(s: np.ndarray) -> np.ndarray:
    sig = signature(s).reshape(-1, ROWS)
    with np.errstate(over="ignore"):
        acc = np.arange(1, len(sig) + 1, dtype=np.uint64)
        for j in range(ROWS):
            acc = _mix(acc * np.uint64(0x9E3779B97F4A7C15) + sig[:, j])
    return acc.view(np.int64)


def _sketches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    for frame in filter(len, frames):
        sets = [shingler.shingles(t) for t in frame["text"]]
        yield pd.DataFrame({
            "doc_id": frame["doc_id"],
            "n_shingles": [len(s) for s in sets],
            "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            "bands": [bands(s) if len(s) else None for s in sets],
        })


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    shingler = Shingler()
    for frame in filter(len, frames):
        yield pd.DataFrame({"rep": frame["rep"], "shingles": [shingler.shingles(t).tobytes() for t in frame["text"]]})


def confirmed(group: pd.DataFrame) -> pd.DataFrame:
    """Of one centre and up to CHUNK members: the pairs at the wanted similarity, 100 * common >= 75 * union."""
    own = group["member"].isna()
    centre = np.frombuffer(group.loc[own, "shingles"].iloc[0], np.uint64)
    out = []
    for member, raw in zip(group.loc[~own, "member"], group.loc[~own, "shingles"], strict=True):
        s = np.frombuffer(raw, np.uint64)
        common = len(np.intersect1d(centre, s, assume_unique=True))
        if 100 * common >= 75 * (len(centre) + len(s) - common):
            out.append(int(member))
    return pd.DataFrame({"a": pd.Series([group["centre"].iloc[0]] * len(out), dtype="int64"), "b": pd.Series(out, dtype="int64")})


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (centre, member), a staged table, whose whole sets are similar enough, as (a, b)."""
    n = F.pmod(F.xxhash64("member"), F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)))
    counts = pairs.groupBy("centre").agg(F.count("*").alias("n"))
    sized = join_heavy(pairs, counts, "centre", heavy_keys(counts, pairs.count(), "centre")).withColumn("chunk", n)
    members = sized.join(sets, sized["member"] == sets["rep"]).select("centre", "chunk", "member", "shingles")
    heads = sized.select("centre", "chunk").distinct().join(sets, F.col("centre") == sets["rep"])
    heads = heads.select("centre", "chunk", F.lit(None).cast("long").alias("member"), "shingles")
    return members.unionByName(heads).groupBy("centre", "chunk").applyInPandas(confirmed, "a long, b long")


def _fits(x: Column, y: Column) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(x, y) >= 75 * F.greatest(x, y)


def _tokens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in filter(len, frames):
        each = [np.frombuffer(x, np.int64) for x in part["shingles"]]
        sizes = [len(x) for x in each]
        yield pd.DataFrame({"rep": np.repeat(part["rep"].to_numpy(), sizes), "component": np.repeat(part["component"].to_numpy(), sizes), "token": np.concatenate(each)})


def _prefixes(left: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, lo, hi, own, component, n, at, members): the documents that a token may link with those of another size.

    left: (rep, n, component). Tokens have one order for all documents, those of the fewest components first. The first token that two
    sets share, at place p of n and q of m, leaves at most min(n - p, m - q) + 1 to share, and 3/7 (n + m) are needed; so for
    each class of the partner's size (a factor of ``SIZE_STEP``) only the first tokens of a set count, and the
    fewer the larger the partner is. A document stands under (token, the smaller and the larger of the two
    classes). Where all documents there are of one component nothing is left to link."""
    tokens = left.join(sets, "rep").select("rep", "component", "shingles").mapInPandas(_tokens, "rep long, component long, token long")
    tokens = stage_frames(tokens, "mh-tokens", 200)
    of_one = tokens.groupBy("token", "component").agg(F.count("*").alias("df"))
    # a token of one component links nothing more and comes first in the order: its place counts, it need not move on
    rare = stage(of_one.groupBy("token").agg(F.count("*").alias("cf"), F.sum("df").alias("df")).where("cf > 1"), "mh-rare")
    own = stage(join_heavy(tokens, rare, "token", heavy_keys(rare, tokens.count(), "token", "df")).drop("component"), "mh-own")
    unstage(tokens)
    unstage(rare)
    n, of_doc = F.col("n"), Window.partitionBy("rep")
    at = n - F.count("*").over(of_doc) + F.row_number().over(of_doc.orderBy("cf", "df", "token"))
    # the longest prefix is that for the smallest partner
    ordered = own.join(left, "rep").withColumn("at", at).where(4 * (n - F.col("at") + 1) >= 3 * n)
    class_of = lambda x: F.floor(F.log(x.cast("double")) / math.log(SIZE_STEP) + 1e-9).cast("int")
    smallest = lambda c: F.greatest(F.pow(F.lit(SIZE_STEP), c) * (1 - 1e-6), n * 0.75)
    reach = lambda c: 7 * (n - F.col("at") + 1) >= 3 * (n + smallest(c)) - 1e-6
    partners = F.filter(F.sequence(class_of(F.greatest(n * 0.75, F.lit(1))) - 1, class_of(n / 0.75) + 1), reach)
    keyed = ordered.withColumn("own", class_of(n)).select("token", "rep", "n", "at", "component", "df", "own", F.explode(partners).alias("other"))
    keyed = keyed.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other"), "salt": F.pmod(F.xxhash64("rep"), F.ceil(F.col("df") / MEMBERS))})
    # arrays of about MEMBERS at most: a token's documents are dealt by the salt
    alike = ["token", "lo", "hi", "own", "component", "n", "at"]
    blocks = stage(keyed.groupBy(*alike, "salt").agg(F.collect_list("rep").alias("members")).drop("salt"), "mh-prefixes")
    unstage(own)
    several = blocks.groupBy("token", "lo", "hi").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("token", "lo", "hi")
    met = stage(blocks.join(several, ["token", "lo", "hi"], "left_semi"), "mh-several")
    unstage(blocks)
    return met


def _meetings(blocks: DataFrame) -> DataFrame:
    """(rep, member): documents of different components that meet in a token and may be similar enough.

    Sizes and places are those of a whole block, so a pair that cannot be is not made."""
    key = ["token", "lo", "hi"]
    a = blocks.where("own = lo").select(*key, "component", "n", "at", F.col("members").alias("xs"))
    b = blocks.where("own = hi").select(*key, F.col("component").alias("other"), F.col("n").alias("mn"), F.col("at").alias("mat"), F.col("members").alias("ys"))
    # within one class of sizes both orders meet: one is enough
    apart = (F.col("component") < F.col("other")) | ((F.col("lo") < F.col("hi")) & (F.col("component") != F.col("other")))
    enough = 7 * (F.least(F.col("n") - F.col("at"), F.col("mn") - F.col("mat")) + 1) >= 3 * (F.col("n") + F.col("mn"))
    met = a.join(b, key).where(apart & enough & _fits(F.col("n"), F.col("mn")))
    return met.select("ys", F.explode("xs").alias("rep")).select("rep", F.explode("ys").alias("member"))


def _prefix_pairs(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (centre, member) of different components that may be similar enough; misses none (see ``_prefixes``)."""
    return _meetings(_prefixes(left, sets)).select(F.least("rep", "member").alias("centre"), F.greatest("rep", "member").alias("member")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_links) of every row; n_links: confirmed links of the
    document's class to other classes that were needed (a spanning part of all)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = texts.withColumn("doc_id", as_text("doc_id")).mapInPandas(_sketches, "doc_id string, n_shingles long, digest binary, bands array<long>")
    rows = stage_frames(as_long(sketches, "doc_id"), "mh-rows")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    reps = full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.count("*").alias("docs"))
    reps = stage(reps, "mh-reps")
    members = reps.select(F.explode("bands").alias("key"), "rep", "n")
    centres = stage(members.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("m")).where("m > 1"), "mh-centres")
    in_buckets = centres.agg(F.sum("m")).first()[0] or 0
    crowded = stage(heavy_keys(centres, in_buckets, "key", "m"), "mh-crowded")
    # only buckets of two or more go on
    shared = stage(join_heavy(members, centres.select("key", "centre"), "key", crowded).select("key", "rep", "n", "centre"), "mh-shared")
    sizes = reps.select(F.col("rep").alias("centre"), F.col("n").alias("cn"))
    star = stage(shared.where("rep <> centre").select("centre", F.col("rep").alias("member"), "n").distinct(), "mh-spokes")
    hubs = heavy_keys(star.groupBy("centre").agg(F.count("*").alias("m")), star.count(), "centre", "m")
    star = stage(join_heavy(star, sizes, "centre", hubs).where(_fits(F.col("n"), F.col("cn"))).select("centre", "member"), "mh-star")
    used = shared.select("rep").distinct()
    text_of = texts.join(used.withColumnRenamed("rep", "doc_id"), "doc_id").groupBy(F.col("doc_id").alias("rep")).agg(F.min("text").alias("text"))
    sets = stage_frames(text_of.mapInPandas(_sets, "rep long, shingles binary"), "mh-sets")
    links = stage(_confirm(star, sets), "mh-links")
    comp = smallest_reachable(links)
    labelled = stage(shared.join(comp, shared["rep"] == comp["node"], "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component")), "mh-labelled")
    several = stage(labelled.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("m")).where("c0 <> c1"), "mh-several")
    left = join_heavy(labelled, several.select("key"), "key", heavy_keys(several, labelled.count(), "key", "m")).select("rep", "n", "component").distinct()
    left = stage(left, "mh-left")
    pairs = stage(_prefix_pairs(left, sets).join(star, ["centre", "member"], "left_anti"), "mh-pairs")
    links = stage(links.union(_confirm(pairs, sets)), "mh-links")
    for table in (centres, crowded, shared, star, sets, labelled, several, left, pairs):
        unstage(table)
    comp = smallest_reachable(links)
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))
    of = reps.join(comp, reps["rep"] == comp["node"], "left").join(degree.withColumnRenamed("node", "dn"), F.col("rep") == F.col("dn"), "left")
    of = stage(of.select("digest", "docs", F.coalesce("component", "rep").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "mh-classes")
    copies = heavy_keys(of, full.count(), "digest", "docs")
    linked = join_heavy(full, of, "digest", copies).select("doc_id", "n_shingles", F.col("component").alias("component_id"), "n_links")
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return linked.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "n_links")
