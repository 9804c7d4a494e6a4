"""Quality classifier with naive Bayes features and a linear hinge-loss model.

Tokens of a text are word shapes: letters, digits and signs by class, runs shortened, and
``=`` for a word that repeats the one before.  Features are indicators of shape n-grams up
to three, of a shape's share of the text in powers of two, and of words, hashed into
``2**18`` places.  Each indicator is scaled by the log-count ratio of the two classes; a
hinge-loss model over the scaled indicators is fitted by dual coordinate descent, and a
logistic curve over held-in margins turns its margins into scores.

The model is fitted in one task on a bounded sample, the ``sample`` labelled training rows
with the smallest hash of their id.  Scoring reads whole texts in one narrow pass.  Null
and empty texts have no features and get the score of the bias.  Labels other than 0 and 1
and rows with a null id are not learned from; an id with several labels counts once per
label; without labels of both classes every score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .shared import Memo, arrow_map, sampled, slices, utf8

BITS = 18
SAMPLE = 6000
THRESHOLD = 0.3
MEMO_WORDS = 50_000
CLASSES = bytes(
    ord("A") if chr(b).isupper() and b < 128 else ord("0") if chr(b).isdigit() and b < 128 else ord("a") if chr(b).isalpha() or b >= 128 else b
    for b in range(256)
)
RUNS = re.compile(rb"(.)\1+", re.DOTALL)
REPEAT = np.uint64(0x3D3D3D3D)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shape_and_word(word: bytes) -> tuple[int, int]:
    shape = RUNS.sub(rb"\1", word.translate(CLASSES))
    return xxhash.xxh64_intdigest(shape, 1), xxhash.xxh64_intdigest(word.lower(), 2)


class Features:
    """Distinct feature places of a text."""

    def __init__(self):
        self.memo = Memo(shape_and_word)

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.split()
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        if not words:
            return np.zeros(0, np.int32)
        both = np.array(list(map(self.memo.__getitem__, words)), np.uint64)
        shape, word = both[:, 0].copy(), both[:, 1]
        shape[1:][word[1:] == word[:-1]] = REPEAT
        kinds, counts = np.unique(shape, return_counts=True)
        share = np.floor(np.log2(counts / len(words))).astype(np.int64).astype(np.uint64)
        found = [kinds, kinds * MIX + share * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(7), word]
        gram = shape
        for n in (1, 2):
            gram = gram[:-1] * MIX + shape[n:] + np.uint64(n)
            found.append(gram)
        values = np.concatenate(found)
        values = (values ^ values >> np.uint64(31)) * MIX >> np.uint64(64 - BITS)
        return np.unique(values.astype(np.int32))


def log_count_ratio(rows: list[np.ndarray], positive: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    counts = [np.full(1 << BITS, alpha), np.full(1 << BITS, alpha)]
    for features, label in zip(rows, positive):
        counts[int(label)][features] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = 0.1, rounds: int = 15) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss, one dual variable per row."""
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    values = [scale[r] / max(1.0, np.sqrt(len(r))) for r in rows]
    square = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(rows)):
            gradient = y[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost * (len(y) / (2 * (y == y[i]).sum())) ** 0.5 * 10)
            if step := (new - alpha[i]) * y[i]:
                weights[rows[i]] += step * values[i]
                bias += step
            alpha[i] = new
    return weights, bias


def margins(rows: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    return np.array([weights[r].sum() / max(1.0, np.sqrt(len(r))) + bias for r in rows])


def logistic_curve(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset that fit the labels' odds to margins, by Newton's method with a small ridge."""
    a, b = 1.0, 0.0
    target = np.where(positive, (positive.sum() + 1) / (positive.sum() + 2), 1 / ((~positive).sum() + 2))
    x = np.stack([margin, np.ones(len(margin))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + np.diag([1e-3, 1e-3])
        step = np.linalg.solve(hessian, x @ (p - target) + 1e-3 * np.array([a, b]))
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return float(max(a, 1e-3)), float(b)


def fit(sample: pd.DataFrame) -> pd.DataFrame:
    """One row: the scaled weights, bias and the curve's slope and offset."""
    sample = sample.sort_values(["doc_id", "label", "text"], na_position="first")
    features = Features()
    rows = [features((text or "").encode()) for text in sample["text"]]
    positive = sample["label"].to_numpy() == 1
    weights, bias, slope, offset = np.zeros(1 << BITS), 0.0, 1.0, 0.0
    if positive.any() and not positive.all():
        y = np.where(positive, 1.0, -1.0)
        fold = np.arange(len(rows)) % 3
        held = np.zeros(len(rows))
        for k in range(3):  # margins of rows that the model has not seen
            inside = np.flatnonzero(fold != k)
            if len(set(y[inside])) == 2:
                ratio = log_count_ratio([rows[i] for i in inside], positive[inside])
                w, c = dual_descent([rows[i] for i in inside], y[inside], ratio)
                out = np.flatnonzero(fold == k)
                held[out] = margins([rows[i] for i in out], w * ratio, c)
        slope, offset = logistic_curve(held, positive)
        ratio = log_count_ratio(rows, positive)
        weights, bias = dual_descent(rows, y, ratio)
        weights = weights * ratio
    return pd.DataFrame({"weights": [weights.astype("<f8").tobytes()], "bias": [bias], "slope": [slope], "offset": [offset]})


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model, learned from the labelled rows that are not held out."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    chosen = sampled(chosen, sample, "id").distinct().orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("id")  # at most ``sample`` ids and labels
    )
    # Rows of a repeated id could exceed the sample, so the bound is set again on the rows.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", F.xxhash64("text")).limit(sample).select("doc_id", "label", "text")
    found = rows.groupBy().applyInPandas(fit, "weights binary, bias double, slope double, offset double").collect()
    return found[0].asDict() if found else {"weights": np.zeros(1 << BITS).tobytes(), "bias": 0.0, "slope": 1.0, "offset": 0.0}


def score(docs: DataFrame, model: dict, carry: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns of ``carry`` and ``score``, the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the corpus
    names = list(dict.fromkeys([*carry, text]))
    at = names.index(text)
    kept = [i for i, name in enumerate(names) if name in carry]
    source = docs.select(*[(F.col(c).cast("string") if c == text else F.col(c)).alias(f"c{i}") for i, c in enumerate(names)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, own = Features(), sent.value
        weights = np.frombuffer(own["weights"], "<f8")
        for batch in slices(batches):
            found = margins([features(x) for x in utf8(batch.column(at))], weights, own["bias"])
            result = 1 / (1 + np.exp(-np.clip(own["slope"] * found + own["offset"], -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(result)], names=[*(f"c{i}" for i in kept), "score"]
            )

    types = [f"c{i} {source.schema[f'c{i}'].dataType.simpleString()}" for i in kept]
    return arrow_map(source, work, ", ".join([*types, "score double"])).select(*[F.col(f"c{i}").alias(names[i]) for i in kept], "score")
