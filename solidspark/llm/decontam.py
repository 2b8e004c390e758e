"""Benchmark decontamination: spaced seeds find where a document and a benchmark item may overlap, aligned tokens decide.

Native: DataFrame functions only. Tokens are runs of letters and digits in lower case. A mask is a fixed
pattern over consecutive tokens that ignores some places, so a seed survives substitutions there. Seeds of
items and documents are joined by hash; a hit fixes the alignment (the difference of the two places). Each
aligned document and item is then compared token by token: an overlap is a window of ``window`` tokens
(the whole item if it is shorter) in which at least ``share`` of the tokens are equal in place.

The three masks were chosen so that no overlap goes without a seed: wherever the substitutions stand that the rule
allows in 8 to 20 tokens, one mask finds five equal ones (the tests try all places). An item of fewer than 8 tokens overlaps
only if all its tokens are there, and is hashed whole.

Seeds of the items are broadcast only if their bytes, summed first, are at most ``MOST_BYTES``;
else the join shuffles the documents' seeds. Results are the same.

Defined cases: null or empty texts have no seeds and overlap nothing; items with equal texts are items of
their own; rows that repeat doc_id and text get the same result; a null doc_id is an id like another; an item with a
null id is reported as no id; ids of items may be of any type; an empty benchmark flags nothing; other columns pass
through, clashing names are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import stage, unstage

#: 1: the token counts, 0: it is ignored.
MASKS = ("111011", "1101011", "11100101")
#: Items with fewer tokens are compared whole; those without tokens (fewer than the second number) not at all.
SHORT, LEAST = 8, 1
MOST_BYTES = 64_000_000


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _seeds(words: str, masks: list[str]) -> Column:
    """The seeds of all masks, one mask after the other, each at every place where it fits."""

    def of(mask: str) -> Column:
        seed = lambda i: F.xxhash64(F.lit(mask), *[F.get(words, i + k) for k, c in enumerate(mask) if c == "1"])
        return F.when(F.size(words) >= len(mask), F.transform(F.sequence(F.lit(0), F.size(words) - len(mask)), seed)).otherwise(F.array().cast("array<bigint>"))

    return F.concat(*map(of, masks))


def _place(k: Column, n: Column, masks: list[str]) -> Column:
    """The place of the k-th of the seeds of n tokens."""
    out, left = k, k
    for mask in masks[:-1]:
        here = F.greatest(n - (len(mask) - 1), F.lit(0))
        out, left = F.when(left >= here, left - here).otherwise(out), left - here
    return out


def _exploded(df: DataFrame, keep: list[str], seeds: Column) -> DataFrame:
    """A row for each seed: the kept columns, ``k`` and ``seed``."""
    # outer, though rows without seeds are not wanted: the filter that Spark infers for a plain explode would be
    # pushed below the tokens and compute them anew for every place; the join drops null seeds
    return df.select(*keep, F.posexplode_outer(seeds).alias("k", "seed"))


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df``, marked for a broadcast if its rows have at most ``MOST_BYTES`` by ``size``."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= MOST_BYTES else df


def overlaps(docs: DataFrame, items: DataFrame, window: int = 20, share: float = 0.8, item_id: str = "item_id", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, th, item_id, matched): items that a document overlaps, with the equal tokens of the best window.

    ``th`` is the hash of the document's text."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    bench = items.select(F.col(item_id).alias("item_id"), tokens(F.col(text_col)).alias("words")).where(F.size("words") >= LEAST).withColumns({"item": F.xxhash64("item_id", "words"), "n": F.size("words")})
    bench = stage(bench, "bench-items")
    whole_of = {r.n: "1" * r.n for r in bench.where(F.col("n") < SHORT).select("n").distinct().collect()}  # fewer than SHORT lengths
    own_seeds = _seeds("words", list(MASKS))
    for n, mask in whole_of.items():
        own_seeds = F.when(F.col("n") == n, _seeds("words", [mask])).otherwise(own_seeds)
    at = F.when(F.col("n") < SHORT, F.lit(0)).otherwise(_place(F.col("k"), F.col("n"), list(MASKS)))
    seeds = _exploded(bench, ["item", "n"], own_seeds).where("seed is not null").groupBy("seed").agg(F.collect_set(F.struct("item", "n", at.alias("at"))).alias("places"))
    seeds = stage(seeds, "bench-seeds")
    masks = [*MASKS, *whole_of.values()]
    words = texts.select("doc_id", "th", tokens(F.col("text")).alias("words")).withColumn("size", F.size("words"))
    hits = _exploded(words, ["doc_id", "th", "size"], _seeds("words", masks)).join(_small(seeds, 50 + 24 * F.size("places")), "seed")
    hits = hits.select("doc_id", "th", _place(F.col("k"), F.col("size"), masks).alias("place"), F.explode("places").alias("p"))
    found = hits.select("doc_id", "th", F.col("p.item").alias("item"), F.col("p.n").alias("n"), (F.col("place") - F.col("p.at")).alias("shift")).distinct()
    found = stage(found, "bench-hits")
    per_doc = found.groupBy(F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th")).agg(F.collect_list(F.struct("item", "n", "shift")).alias("hits"))
    whole = texts.join(per_doc, texts["doc_id"].eqNullSafe(per_doc["hit_id"]) & (texts["th"] == per_doc["hit_th"])).dropDuplicates(["doc_id", "th"])
    whole = whole.select("doc_id", "th", tokens(F.col("text")).alias("own"), F.explode("hits").alias("h")).select("doc_id", "th", "own", "h.*")
    # of the document only what stands against the item goes on; it starts at the item's place -shift, or 0
    part = F.slice("own", F.greatest("shift", F.lit(0)) + 1, F.greatest(F.col("n") + F.least("shift", F.lit(0)), F.lit(0)))
    parts = whole.select("doc_id", "th", "item", part.alias("part"), F.greatest(-F.col("shift"), F.lit(0)).alias("at"))
    pairs = parts.join(_small(bench.select("item_id", "item", "words", "n"), 100 + F.octet_length(F.array_join("words", " ")) + 16 * F.col("n")), "item")
    pairs = pairs.withColumn("wide", F.least("n", F.lit(window)))
    equal = lambda j: (F.coalesce(F.get("part", j - F.col("at")) == F.get("words", j), F.lit(False)) & (j >= F.col("at"))).cast("int")

    def slide(acc: Column, j: Column) -> Column:
        """The window that ends at j: its equal tokens, and the most so far."""
        now = acc.now + equal(j) - F.when(j >= F.col("wide"), equal(j - F.col("wide"))).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(acc.best, now).alias("best"))

    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))
    pairs = pairs.withColumn("matched", F.aggregate(F.sequence(F.lit(0), F.size("words") - 1), start, slide, lambda acc: acc.best))
    needed = F.when(F.col("n") < SHORT, F.col("n").cast("double")).otherwise(F.lit(share) * F.col("wide"))
    result = pairs.where(F.col("matched") >= needed).groupBy("doc_id", "th", "item_id").agg(F.max("matched").cast("long").alias("matched"))
    result = stage(result, "bench-overlaps")
    for table in (bench, seeds, found):
        unstage(table)
    return result


def flag(docs: DataFrame, items: DataFrame, window: int = 20, share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs``, then ``contaminated``, ``n_items``, ``best_match`` and ``item_ids``."""
    found = overlaps(docs, items, window, share, id_col=id_col, text_col=text_col)
    per = found.groupBy(F.col("doc_id").alias("_fid"), F.col("th").alias("_fth")).agg(
        F.count("*").alias("_n"), F.max("matched").alias("_m"), F.array_sort(F.collect_set("item_id")).alias("_ids")
    )
    per = stage(per, "bench-found")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    key = F.col("_row").getField(id_col).eqNullSafe(F.col("_fid")) & (F.xxhash64(F.col("_row").getField(text_col)) == F.col("_fth"))
    joined = rows.join(per, key, "left")
    new = ("contaminated", "n_items", "best_match", "item_ids")
    return joined.select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in new],
        F.col("_n").isNotNull().alias("contaminated"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("_m", F.lit(0)).cast("long").alias("best_match"),
        F.coalesce("_ids", F.array().cast(per.schema["_ids"].dataType)).alias("item_ids"),
    )
