"""Quality classifier: positive-unlabelled learning with the non-negative risk estimator.

Positives are documents labelled 1; the unlabelled set is all documents that may train. The class prior is
estimated from the labelled training rows. The risk pi * R_P(+1) + max(0, R_U(-1) - pi * R_P(-1)) of a logistic
scorer (Kiryo et al. 2017) is minimised over all of them. Values, gradients and curvature of its parts are sums over
rows, which tasks add up, so that a Newton step is a pass over the rows. Where a step would take the second part below 0, it
goes along the line where that part is 0, and going below has a price: so the scorer does not fit the
unlabelled set's noise.

Inputs of a score are measures of the whole text alone: shares of kinds of characters, repetition of
words, lines and sentences, lengths. They are computed once and kept as a table, which every step reads.

Defined cases: a null text is an empty one; an empty text gets the score of its features (all zeros but
the emptiness); a document with several label rows counts once, as 1 if any is 1; null labels count as
unlabelled; rows with a null doc_id are scored and are unlabelled; without positives every score is the
prior (0.5 without labels); repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solidspark.llm.common import as_long, as_text, stage, stage_frames, unstage

THRESHOLD, FOLDS = 0.3, 5
#: Weight of the squares of weights (of standardised inputs); steps end when the risk falls by less, or after so many.
DECAY, GAIN, STEPS = 2e-3, 1e-4, 40
#: What a second part below 0 costs.
PRICE = 3.0
SYMBOLS = "!|$%&#*@<>{}=_/\\+~^?:;,.-\"'()"


def features(text: str) -> np.ndarray:
    """Measures of a text, all between 0 and about 1 but the logarithms of lengths."""
    raw = text.encode("utf-8")
    n = max(1, len(raw))
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    upper, lower, digit = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum()
    words = text.split()
    k = max(1, len(words))
    lines = text.split("\n")
    out = [float(not words), np.log1p(len(words)) / 10, np.log1p(len(lines)) / 6, upper / n, lower / n, digit / n, hist[128:].sum() / n, hist[10] / n, hist[32] / n]
    out += [hist[ord(c)] / k for c in SYMBOLS]
    out += [
        min(30.0, sum(map(len, words)) / k) / 30,
        len(set(words)) / k,
        sum(map(eq, words, words[1:])) / k,
        sum(w.isupper() for w in words) / k,
        sum(w[-1] in "!|$%&#*@" for w in words) / k,
        len(set(lines)) / len(lines),
        upper / max(1, upper + lower),
    ]
    return np.array(out, np.float32)


N_FEATURES = len(features(""))


def expand(x: np.ndarray) -> np.ndarray:
    """Each measure as it is, its root, and cut off at small values, and a constant."""
    x = np.clip(x, 0, None)
    return np.concatenate([x, np.sqrt(x), np.minimum(x, 0.02) * 50, np.minimum(x, 0.2) * 5, np.ones((len(x), 1))], axis=1)


def standardised(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return (expand(x) - mean) / spread


def sums_at(z: np.ndarray, positive: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    """For each of some weights: counts, losses, gradient and curvature of rows, in one vector that may be added up.

    In order: unlabelled rows and their sum of R_U(-1); positives with their sums of R_P(-1) and R_P(+1); the gradient of
    R_U(-1), the sum of the positives, the gradient of R_P(-1); the upper triangle of the curvature of R_U(-1) (of the first weights alone)."""
    out = []
    for k, w in enumerate(weights):
        s = z @ w
        loss, p = np.logaddexp(0, s), 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        head = [len(z), loss.sum(), positive.sum(), loss[positive].sum(), np.logaddexp(0, -s[positive]).sum()]
        if k == 0:
            bent = (z.T * (p * (1 - p))) @ z
            head = [*head, *(z.T @ p), *z[positive].sum(0), *(z[positive].T @ p[positive]), *bent[np.triu_indices(z.shape[1])]]
        out.append(np.array(head))
    return out


def risk_of(head: np.ndarray, prior: float) -> tuple[float, float]:
    """Of a head of :func:`sums_at`: the risk, with a price on a second part below 0, and the second part."""
    negative = head[1] / head[0] - prior * head[3] / head[2]
    return prior * head[4] / head[2] + max(negative, -PRICE * negative), negative


def fit(totals: Callable[[list[np.ndarray]], list[np.ndarray]], prior: float, n: int, steps: int = STEPS) -> np.ndarray:
    """Weights of ``n`` inputs that minimise the non-negative risk. ``totals`` adds :func:`sums_at` up over all rows."""
    w, upper = np.zeros(n), np.triu_indices(n)

    def risks(heads: list[np.ndarray], at: list[np.ndarray]) -> list[float]:
        return [risk_of(h, prior)[0] + DECAY / 2 * v @ v for h, v in zip(heads, at, strict=True)]

    (now,) = totals([w])
    for _ in range(steps):
        of_u, of_p, bend_p, curve = np.split(now[5:], [n, 2 * n, 3 * n])
        (risk,), negative = risks([now], [w]), risk_of(now, prior)[1]
        bent = np.zeros((n, n))
        bent[upper] = curve / now[0]
        bent = bent + np.triu(bent, 1).T + DECAY * np.eye(n)
        # of the risk while its second part is positive, and of that part
        gradient, slope = of_u / now[0] - prior * of_p / now[2] + DECAY * w, of_u / now[0] - prior * bend_p / now[2]
        step, turn = np.linalg.solve(bent, gradient), np.linalg.solve(bent, slope)
        step = step - max(0.0, (slope @ step - negative) / max(slope @ turn, 1e-12)) * turn
        (after,) = totals([w - step])
        if risks([after], [w - step])[0] <= risk - GAIN:
            w, now = w - step, after
            continue
        shorter = [w - a * step for a in (0.5, 0.25, 0.1, 0.03, 0.01)]  # in one pass
        tried = risks(totals(shorter), shorter)
        k = int(np.argmin(tried))
        if tried[k] > risk - GAIN:
            break
        w = shorter[k]
        (now,) = totals([w])
    return w


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"doc_id": frame["doc_id"], "x": [features(t or "").tobytes() for t in frame["text"]]})


def _matrix(raw: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float32).reshape(-1, N_FEATURES)


def _total(train: DataFrame, of: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """Vectors of the rows (features, positive), added up in the tasks and then over them: a row a task and vector."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            for low in range(0, len(frame), 2_000):
                part = frame.iloc[low : low + 2_000]
                own = of(_matrix(part["x"]), part["positive"].to_numpy(bool))
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total is not None:
            yield pd.DataFrame({"k": range(len(total)), "v": [x.tolist() for x in total]})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": group["k"].iloc[:1], "v": [np.sum([np.asarray(v) for v in group["v"]], axis=0).tolist()]})

    tasks = train.select("x", "positive").mapInPandas(sums, "k int, v array<double>")
    # in two steps, so that no task adds all tasks' vectors
    some = tasks.groupBy("k", (F.spark_partition_id() % 64).alias("part")).applyInPandas(added, "k int, v array<double>")
    return [np.array(r.v) for r in some.groupBy("k").applyInPandas(added, "k int, v array<double>").orderBy("k").collect()]


def _train(train: DataFrame, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, and the mean and spread of the inputs."""

    def moments(x: np.ndarray, _: np.ndarray) -> list[np.ndarray]:
        z = expand(x).astype(np.float64)
        return [np.r_[len(z), z.sum(0), (z * z).sum(0)]]

    (m,) = _total(train, moments)
    n = (len(m) - 1) // 2
    mean = m[1 : 1 + n] / m[0]
    spread = np.sqrt(np.maximum(m[1 + n :] / m[0] - mean**2, 0)) + 1e-3
    mean[-1], spread[-1] = 0, 1
    w = fit(lambda weights: _total(train, lambda x, positive: sums_at(standardised(x, mean, spread), positive, weights)), prior, n)
    return w, mean, spread


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; labels: (doc_id, quality)."""
    rows = docs.select(as_text(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage_frames(as_long(rows.mapInPandas(_measure, "doc_id string, x binary"), "doc_id"), "quality-features")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), "quality").where("quality is not null").groupBy("label_id").agg(F.max("quality").alias("quality"))
    train = rows.where(~held).join(known, F.col("doc_id") == F.col("label_id"), "left").select("x", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("positive"), F.col("quality").isNotNull().alias("labelled"))
    train = stage(train, "quality-training")
    n, ones = train.agg(F.count_if("labelled"), F.count_if("positive")).first()
    prior = min(0.98, max(0.02, ones / n)) if n else 0.5
    model = _train(train, prior) if ones else None
    unstage(train)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole, low in ((frame, low) for frame in frames for low in range(0, len(frame), 2_000)):
            frame = whole.iloc[low : low + 2_000]
            z = standardised(_matrix(frame["x"]), *model[1:]) @ model[0] if model and len(frame) else np.full(len(frame), np.log(prior / (1 - prior)))
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "score": s, "predicted": (s >= THRESHOLD).astype("int32")})

    found = as_long(rows.withColumn("doc_id", as_text("doc_id")).mapInPandas(apply, "doc_id string, score double, predicted int"), "doc_id")
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")
