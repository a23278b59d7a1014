"""Toxic text by character n-grams scaled with naive Bayes log-count ratios.

A text is the set of its character n-grams, hashed. From the labelled rows
each n-gram gets the log of how much more often toxic texts hold it than
others do. A linear classifier is fitted to the texts with their n-grams
scaled by these ratios, so it starts from what each n-gram says by itself.
"""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.labelled import fit_in_one_task, labelled_sample, remainder, scored, sigmoid

# Labelled rows that a model is fitted to, at most.
SAMPLE_ROWS = 10_000
HELD_OUT_OF = 4
HELD_OUT = 2

GRAMS = (4, 5, 6)
BUCKETS = 1 << 18
# N-grams that the classifier weighs: those whose ratios say most.
WEIGHED = 1 << 14

_U32 = np.uint32
_PLACES = np.random.default_rng(7).integers(1, 1 << 31, max(GRAMS), dtype=np.uint32) * _U32(2) + _U32(1)


class GramSet:
    """Distinct hashed n-grams of one text after another, with one table for all."""

    def __init__(self) -> None:
        self.seen = np.zeros(BUCKETS, bool)

    def __call__(self, text: bytes | None) -> np.ndarray:
        """Upper case (A to Z) and runs of blanks do not count."""
        body = b" " + b" ".join((text or b"").lower().split()) + b" "
        letters = np.frombuffer(body.decode(errors="replace").encode("utf-32-le"), "<u4")
        running = np.zeros(len(letters), np.uint32)
        for length in range(1, max(GRAMS) + 1):
            ends = len(letters) - length + 1
            if ends <= 0:
                break
            running = running[:ends] + letters[length - 1 :] * _PLACES[length - 1]
            if length in GRAMS:
                mixed = (running ^ (running >> _U32(15))) * _U32(0x2C1B3C6D) + _U32(length)
                self.seen[(mixed ^ (mixed >> _U32(12))) % _U32(BUCKETS)] = True
        found = np.flatnonzero(self.seen)
        self.seen[found] = False
        return found


def _features():
    grams = GramSet()
    return lambda text: grams(text).astype("<i4").tobytes()


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratio of each n-gram, and in how many texts it is."""
    toxic, other = np.ones(BUCKETS), np.ones(BUCKETS)
    for grams, label in zip(rows, labels, strict=True):
        (toxic if label else other)[grams] += 1
    texts = toxic + other - 2
    return np.log(toxic / (labels.sum() + 2)) - np.log(other / ((1 - labels).sum() + 2)), texts


def fit(packed: list[bytes], labels: np.ndarray, epochs: int = 60, shrink: float = 5e-3) -> bytes:
    """Weights of all n-grams and a bias, fitted by gradients with moments (Adam)."""
    rows = [np.frombuffer(row, "<i4") for row in packed]
    ratios, texts = log_count_ratios(rows, labels)
    # How much an n-gram says: its ratio, counted more if more texts show it.
    telling = np.where(texts >= 2, np.abs(ratios) * np.sqrt(texts), 0)
    chosen = np.sort(np.argpartition(-telling, WEIGHED)[:WEIGHED])
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(WEIGHED)
    kept = [p[p >= 0] for p in (place[grams] for grams in rows)]
    owner = np.repeat(np.arange(len(kept)), [len(p) for p in kept])
    column = np.concatenate(kept) if kept else np.empty(0, np.int64)
    scale = ratios[chosen]
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    weights, bias = np.full(WEIGHED, 0.1), float(np.log(share / (1 - share)))
    first, second = np.zeros(WEIGHED + 1), np.zeros(WEIGHED + 1)
    for step in range(1, epochs * 5 + 1):
        found = bias + np.bincount(owner, (weights * scale)[column], len(rows))
        error = sigmoid(found) - labels
        slope = np.bincount(column, error[owner], WEIGHED) * scale / len(rows) + shrink * weights
        slope = np.append(slope, error.mean())
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        move = 0.02 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    table = np.zeros(BUCKETS, np.float32)
    table[chosen] = weights * scale
    out = io.BytesIO()
    np.savez_compressed(out, bias=bias, table=table)
    return out.getvalue()


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS
) -> bytes | None:
    """The classifier learnt from the labelled rows that are not held out.

    ``labels`` has doc_id and the label; 1 stands for toxic. Rows with NULL in
    either are passed over. None if no row is left.
    """
    sample = labelled_sample(
        docs, labels, label, lambda i: remainder(i, HELD_OUT_OF) != HELD_OUT, sample_rows
    )
    grams = None

    def features(text):
        nonlocal grams
        grams = grams or _features()
        return grams(text)

    return fit_in_one_task(sample, features, fit)


def score(
    docs: DataFrame, model: bytes | None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per input row: id, held_out, score from 0 to 1.

    Only the text is scored, the whole of it; NULL and empty texts get the
    score of a text without n-grams. Without a model every score is 0.5.
    Repeated rows and NULL ids are scored like others.
    """
    parts = np.load(io.BytesIO(model)) if model else None
    bias, table = (float(parts["bias"]), parts["table"]) if model else (0.0, None)
    grams = None

    def scores(texts):
        nonlocal grams
        if table is None:
            return np.full(len(texts), 0.5)
        grams = grams or GramSet()
        return sigmoid(np.array([bias + float(table[grams(t)].sum()) for t in texts]))

    found = scored(docs, scores, text, doc_id)
    held_out = remainder(F.col("id"), HELD_OUT_OF) == HELD_OUT
    return found.select("id", held_out.alias("held_out"), "score")
