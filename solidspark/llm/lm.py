"""LM scoring: a hidden Markov language model trained by Baum-Welch over all training documents.

The text is a sequence of tokens (words in ASCII lower case, then one end). A latent state emits a word
class, and the class emits the word: P(word | state) = E[state, class] * P(word | class). The class is
a hash of the word (words are told apart by 64-bit hashes), so E has a fixed size at any vocabulary, and P(word | class) comes from counts of all
training tokens, which are aggregated and joined as tables and never broadcast. Expected counts of each
Baum-Welch pass, all over the whole training corpus, are summed per partition in the tasks and added up by a
group-by; the driver holds the parameters only (STATES x CLASSES).

The likelihood is exact: the scaled forward recursion runs over every token of every text, many texts
side by side. Words of one class have the same P(class | state), so log10 P(text) is the forward value of
the class sequence plus the sum of log10 P(word | class).

Words: a class keeps a share of its mass for one unknown word, by the training words seen once (and 0.1).
Over the classes, known words and the unknown word of each class, the emissions of a state add up to 1.

Texts are tokenised once, in blocks of bounded size; a block's distinct words are joined with the counts
and come back to the block, so that no task sees more vocabulary than its block has.

Defined cases: a null or empty text is the end token alone; rows with a null doc_id train (they are not
held out); repeated rows count each time and are scored each; an empty table gives an empty result, and
where nothing is left to train on every token is unknown; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import as_long, as_text, lower_words, stage

STATES, CLASSES = 6, 1 << 15
#: Baum-Welch ends with the pass that raises the log10 likelihood by less than this a token, or after so many.
GAIN, PASSES = 1e-3, 40
#: Characters of text in a block, about.
BLOCK_CHARS = 12_000_000
#: Blocks that a task of a pass reads, where there are many.
BLOCKS_A_TASK = 16
SMOOTH = 0.1
#: The end of a text, as a word; no text has it, for it holds a space.
END = b" end"


def _packed(ids: np.ndarray) -> bytes:
    """Small whole numbers, compressed: low bytes first, then the higher ones."""
    return zstandard.compress(np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int32)


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of two kinds: documents (token numbers within the block, classes) and the words of the block
    (number, hash, count in training documents)."""
    empty = {"doc_id": object, "held_out": "boolean", "n_tokens": "Int64", "local": object, "classes": object, "place": "Int32", "word": "Int64", "train_n": "Int64"}

    def close(docs: list, words: dict[bytes, int]) -> Iterator[pd.DataFrame]:
        block = uuid.uuid4().int >> 65  # the table is written once, so a rerun of the task replaces the block whole
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        classes = (hashes % np.uint64(CLASSES)).astype(np.int32)
        learnt = [local for _, held, local in docs if not held]
        train = np.bincount(np.concatenate(learnt), minlength=len(words)) if learnt else np.zeros(len(words), np.int64)
        parts = [
            pd.DataFrame({
                "doc_id": pd.Series([d for d, _, _ in docs], dtype=object),
                "held_out": [h for _, h, _ in docs],
                "n_tokens": [len(x) for _, _, x in docs],
                "local": [_packed(x) for _, _, x in docs],
                "classes": [None if h else _packed(classes[x]) for _, h, x in docs],
            }),
            pd.DataFrame({"place": np.arange(len(words), dtype=np.int32), "word": hashes.view(np.int64), "train_n": train.astype(np.int64)}),
        ]
        for part in parts:
            missing = {k: pd.Series([None] * len(part), dtype=t) for k, t in empty.items() if k not in part}
            yield part.assign(block=block, **missing)[["block", *empty]]

    docs, words, size = [], {}, 0
    for frame in frames:
        for doc_id, held, text in zip(frame["doc_id"], frame["held_out"], frame["text"], strict=True):
            own = lower_words(text)
            own.append(END)
            for w in dict.fromkeys(own):
                if w not in words:
                    words[w] = len(words)
            docs.append((doc_id, bool(held), np.fromiter(map(words.__getitem__, own), np.int32, len(own))))
            size += len(text or "") + 8
            if size >= BLOCK_CHARS:
                yield from close(docs, words)
                docs, words, size = [], {}, 0
    if docs:
        yield from close(docs, words)


class Model:
    """pi: start, A: transitions, E: STATES x CLASSES emissions of classes."""

    def __init__(self, pi: np.ndarray, A: np.ndarray, E: np.ndarray):
        self.pi, self.A, self.E = pi, A, E

    def single(self) -> Model:
        """In single precision, which is enough for expected counts; likelihoods are in double."""
        return Model(*(x.astype(np.float32) for x in (self.pi, self.A, self.E)))

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        k = STATES
        A = np.full((k, k), 0.05 / (k - 1))
        np.fill_diagonal(A, 0.95)
        E = unigram[None, :] * rng.uniform(0.5, 1.5, (k, len(unigram)))
        return cls(np.full(k, 1 / k), A, E / E.sum(1, keepdims=True))

    @classmethod
    def of_counts(cls, pi: np.ndarray, A: np.ndarray, E: np.ndarray, unigram: np.ndarray) -> Model:
        """Re-estimates, smoothed by the unigram distribution of classes."""
        E = E + 5.0 * unigram[None, :] * len(unigram) ** 0.5 + 1e-12
        return cls((pi + 1) / (pi + 1).sum(), (A + 0.1) / (A + 0.1).sum(1, keepdims=True), E / E.sum(1, keepdims=True))


def _side_by_side(seqs: list[np.ndarray], tokens: int = 500_000) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Indexes and sequences, longest first, in groups of about so many tokens."""
    order = np.argsort([-len(s) for s in seqs], kind="stable")
    at = 0
    while at < len(order):
        n, width = 0, at
        while width < len(order) and (n == 0 or n + len(seqs[order[width]]) <= tokens):
            n += len(seqs[order[width]])
            width += 1
        yield order[at:width], [seqs[i] for i in order[at:width]]
        at = width


def _time_major(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in order of place then sequence, and how many sequences have each place; seqs: longest first."""
    lengths = np.array([len(s) for s in seqs])
    width = np.cumsum(np.bincount(lengths)[::-1])[::-1][1:]
    starts = np.r_[0, np.cumsum(width)]
    flat = np.empty(starts[-1], np.int64)
    for i, s in enumerate(seqs):
        flat[starts[: len(s)] + i] = s
    return flat, starts


def _alphas(model: Model, flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The scaled forward recursion: P(state | tokens so far) and scales of every token, and P(token | state); a row a state."""
    emit = model.E.take(flat, 1)
    alphas, scales, step = np.empty_like(emit), np.empty(len(flat), emit.dtype), np.ascontiguousarray(model.A.T)
    bounds = starts.tolist()
    for t in range(len(bounds) - 1):
        a, b = bounds[t], bounds[t + 1]
        p = bounds[t - 1]
        x = emit[:, a:b] * (step @ alphas[:, p : p + b - a] if t else model.pi[:, None])
        s = scales[a:b] = x.sum(0)
        np.divide(x, s, out=alphas[:, a:b])
    return alphas, scales, emit


def forward(model: Model, seqs: list[np.ndarray]) -> np.ndarray:
    """Exact log10 likelihood of each sequence of classes, by the scaled forward recursion."""
    out = np.zeros(len(seqs))
    for index, group in _side_by_side(seqs):
        flat, starts = _time_major(group)
        _, scales, _ = _alphas(model, flat, starts)
        place = np.arange(len(flat)) - np.repeat(starts[:-1], np.diff(starts))
        out[index] = np.bincount(place, weights=np.log10(scales), minlength=len(group))
    return out


def expected_counts(model: Model, seqs: list[np.ndarray], logs: list[float] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected starts, transitions and emissions (STATES x CLASSES) over the sequences; ``logs`` gets
    log10 likelihoods of groups of them."""
    k = len(model.pi)
    pi, A, counts = np.zeros(k), np.zeros((k, k)), np.zeros((k, model.E.shape[1]))
    for _, group in _side_by_side(seqs):
        flat, starts = _time_major(group)
        alphas, scales, ahead = _alphas(model, flat, starts)
        if logs is not None:
            logs.append(float(np.log10(scales).sum(dtype=np.float64)))
        ahead /= scales
        betas, bounds = np.ones_like(alphas), starts.tolist()
        for t in range(len(bounds) - 2, 0, -1):
            a, b = bounds[t], bounds[t + 1]
            p = bounds[t - 1]
            x = ahead[:, a:b]
            x *= betas[:, a:b]
            np.matmul(model.A, x, out=betas[:, p : p + b - a])
        width = np.diff(starts)
        before = np.arange(starts[1], len(flat)) - np.repeat(width[:-1], width[1:])
        A += (alphas.take(before, 1) @ ahead[:, starts[1] :].T) * model.A
        alphas *= betas
        pi += alphas[:, : starts[1]].sum(1)
        for s in range(k):
            counts[s] += np.bincount(flat, weights=alphas[s], minlength=counts.shape[1])
    return pi, A, counts


def _sequences(raw: pd.Series) -> list[np.ndarray]:
    return [_unpacked(x) for x in raw]


def _pass(blocks: DataFrame, n_blocks: int, model: Model, unigram: np.ndarray) -> tuple[Model, float]:
    """One pass over all training documents: expected counts per partition, added up by row of parameters.

    The new model, and the log10 likelihood of the documents under the given one."""
    context = blocks.sparkSession.sparkContext
    shared = context.broadcast(model.single())
    sums = [f"s{s}" for s in range(STATES)]

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, logs = None, []
        for frame in frames:
            own = expected_counts(shared.value, _sequences(frame["classes"]), logs)
            total = own if total is None else tuple(x + y for x, y in zip(total, own, strict=True))  # sums are in double
        if total is not None:
            pi, A, E = total
            likelihood = np.full((1, STATES), sum(logs))
            table = np.concatenate([E.T, pi[None, :], A, likelihood])  # CLASSES rows, then the start's, the states', the likelihood's
            yield pd.DataFrame(table, columns=sums).assign(row=np.arange(len(table)))[["row", *sums]]

    # a task sends CLASSES rows whatever it read, so it reads several blocks
    train = blocks.where("classes is not null").select("classes").coalesce(max(2 * context.defaultParallelism, n_blocks // BLOCKS_A_TASK))
    counted = train.mapInPandas(count, "row int, " + ", ".join(f"{s} double" for s in sums)).groupBy("row").agg(*[F.sum(s).alias(s) for s in sums])
    rows = counted.toPandas().sort_values("row")
    table = np.zeros((CLASSES + 1 + STATES + 1, STATES))
    table[rows["row"].to_numpy()] = rows[sums].to_numpy()
    shared.unpersist()
    return Model.of_counts(table[CLASSES], table[CLASSES + 1 : -1], table[:CLASSES].T, unigram), float(table[-1, 0])


def train(blocks: DataFrame, unigram: np.ndarray, tokens: int) -> Model:
    """Passes over all training documents, of whatever length, until the likelihood hardly rises."""
    model, before, n_blocks = Model.start(unigram), -np.inf, blocks.select("block").distinct().count()
    for _ in range(PASSES if tokens else 0):
        model, now = _pass(blocks, n_blocks, model, unigram)
        if now - before < GAIN * tokens:
            break
        before = now
    return model


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    ids = F.col(id_col).cast("long")
    held = F.coalesce(F.crc32(ids.cast("string").cast("binary")) % 10 == 0, F.lit(False))
    texts = docs.select(as_text(ids).alias("doc_id"), held.alias("held_out"), F.col(text_col).alias("text"))
    schema = "block long, doc_id string, held_out boolean, n_tokens long, local binary, classes binary, place int, word long, train_n long"
    blocks = stage(texts.mapInPandas(_blocks, schema), "lm-blocks")
    words = blocks.where("word is not null").select("block", "word", "place", "train_n")
    counts = stage(words.where("train_n > 0").groupBy("word").agg(F.sum("train_n").alias("c")), "lm-counts")
    # the hash is unsigned
    class_of = F.pmod("word", F.lit(CLASSES)).cast("int")
    # by class: at most CLASSES rows
    by_class = counts.groupBy(class_of.alias("class")).agg(F.sum("c").alias("c"), F.count("*").alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("once")).toPandas()
    total, distinct = int(by_class["c"].sum()), int(by_class["v"].sum())
    c, v, once = (np.zeros(CLASSES) for _ in range(3))
    at = by_class["class"].to_numpy()
    c[at], v[at], once[at] = by_class["c"], by_class["v"], by_class["once"]
    unknown = once + SMOOTH
    of_class = c + SMOOTH * v + unknown  # what the words of a class share, the unknown one among them
    unigram = of_class / of_class.sum()
    model = train(blocks, unigram, total)
    shared = spark.sparkContext.broadcast((model, unknown, of_class))
    base_of = float(total + SMOOTH * (distinct + 1))

    def scored(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        model, unknown, of_class = shared.value
        place, n, cls = words["place"].to_numpy(), words["c"].to_numpy(), words["class"].to_numpy()
        base, within, known = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words), bool)
        known[place] = n > 0
        base[place] = np.log10((n + SMOOTH) / base_of)
        within[place] = np.log10(np.where(n > 0, n + SMOOTH, unknown[cls]) / of_class[cls])
        classes = np.zeros(len(words), np.int32)
        classes[place] = cls
        local = _sequences(docs["local"])
        states = forward(model, [classes[x] for x in local])
        return pd.DataFrame({
            "doc_id": docs["doc_id"],
            "held_out": docs["held_out"],
            "n_tokens": [len(x) for x in local],
            "n_known": [int(known[x].sum()) for x in local],
            "train_tokens": total,
            "base_score": [float(base[x].sum()) for x in local],
            "score": states + np.array([float(within[x].sum()) for x in local]),
        })

    joined = words.drop("train_n").join(counts.select("word", "c"), "word", "left").select(F.col("block").alias("of"), "place", class_of.alias("class"), F.coalesce("c", F.lit(0)).alias("c"))
    own = blocks.where("local is not null").select("block", "doc_id", "held_out", "local")
    out = "doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return as_long(own.groupBy("block").cogroup(joined.groupBy("of")).applyInPandas(scored, out), "doc_id")
