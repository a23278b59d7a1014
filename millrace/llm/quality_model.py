"""Text quality by a factorisation machine.

A document is a sparse vector: its hashed words, scaled to length 1, and one
feature per structure statistic, which says in which of the statistic's steps
the document falls. Each feature has a weight and a short factor vector; the
product of two features' vectors weighs their occurring together. The sum over
all pairs is taken in linear time: half the square of the sum less half the sum
of the squares, per factor.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.labelled import fit_in_one_task, labelled_sample, remainder, scored, sigmoid

# Labelled rows that a model is fitted to, at most.
SAMPLE_ROWS = 10_000
HELD_OUT_OF = 5
HELD_OUT = 0

WORD_BUCKETS = 1 << 14
FACTORS = 8
STEPS = 12
_STATISTICS = 13
FEATURES = WORD_BUCKETS + _STATISTICS * STEPS
_CAPITALS = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_LETTERS = _CAPITALS + bytes(range(97, 123)) + bytes(range(128, 256))
_SYMBOLS = b"#*$%&|<>@^_~=+{}[]\\/"
_MARKS = b"!?"
_STOPS = b".,;:"


def _share(body: bytes, of: bytes) -> float:
    return (len(body) - len(body.translate(None, of))) / max(len(body), 1)


def statistics(text: bytes, words: list[bytes]) -> np.ndarray:
    """Structure of a text, each value between 0 and 1."""
    n = max(len(words), 1)
    body = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    distinct = len(set(words))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return np.array(
        [
            min(np.log1p(len(words)) / 12, 1),
            min(len(body) / n / 20, 1),
            distinct / n,
            repeats / n,
            pairs / n,
            1 - len(set(lines)) / max(len(lines), 1),
            min(np.log1p(len(lines)) / 8, 1),
            _share(body, _CAPITALS),
            _share(body, _DIGITS),
            _share(body, _SYMBOLS),
            _share(body, _MARKS),
            _share(body, _STOPS),
            _share(body, _LETTERS),
        ]
    )


def describe(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text. An empty text has structure only."""
    text = text or b""
    words = text.split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    counts = np.bincount((hashes % np.uint64(WORD_BUCKETS)).astype(np.int64), minlength=WORD_BUCKETS)
    used = np.flatnonzero(counts)
    values = np.log1p(counts[used])
    values /= max(np.sqrt((values * values).sum()), 1e-9)
    # Square roots spread out the small shares, where most of the difference lies.
    steps = np.minimum(np.sqrt(statistics(text, words)) * STEPS, STEPS - 1).astype(np.int64)
    places = WORD_BUCKETS + np.arange(_STATISTICS) * STEPS + steps
    return np.concatenate([used, places]), np.concatenate([values, np.full(_STATISTICS, 0.5)])


def packed(text: bytes | None) -> bytes:
    numbers, values = describe(text)
    return numbers.astype("<i4").tobytes() + values.astype("<f4").tobytes()


def _unpacked(row: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(row) // 8
    return np.frombuffer(row, "<i4", n), np.frombuffer(row, "<f4", n, 4 * n)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def sums(self, numbers, values, starts):
        """Scores before the sigmoid, and per document the sum of its factors."""
        v = self.factors[numbers] * values[:, None]
        total = np.add.reduceat(v, starts)
        pairs = 0.5 * (total**2 - np.add.reduceat(v * v, starts)).sum(axis=1)
        linear = np.add.reduceat(self.weights[numbers] * values, starts)
        return self.bias + linear + pairs, total

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        numbers, values, starts = _joined(rows)
        return sigmoid(self.sums(numbers, values, starts)[0])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, weights=self.weights, factors=self.factors)
        return out.getvalue()

    @staticmethod
    def from_bytes(model: bytes) -> Machine:
        parts = np.load(io.BytesIO(model))
        return Machine(float(parts["bias"]), parts["weights"], parts["factors"])


def _joined(rows):
    sizes = np.array([len(numbers) for numbers, _ in rows])
    starts = np.cumsum(sizes) - sizes
    return (
        np.concatenate([numbers for numbers, _ in rows]).astype(np.int64),
        np.concatenate([values for _, values in rows]).astype(np.float64),
        starts,
    )


def fit(
    rows: list[bytes],
    labels: np.ndarray,
    epochs: int = 8,
    steps: int = 400,
    rate: float = 0.1,
    shrink: float = 1e-4,
    batch: int = 128,
) -> bytes:
    """A machine fitted by stochastic gradients with a step size per parameter.

    It takes ``epochs`` rounds over the rows, and on few rows more of them
    until it has taken ``steps`` steps.
    """
    random = np.random.default_rng(2)
    described = [_unpacked(row) for row in rows]
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    model = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(FEATURES),
        random.normal(0, 0.02, (FEATURES, FACTORS)),
    )
    seen_w, seen_v, seen_b = np.full(FEATURES, 1e-6), np.full((FEATURES, FACTORS), 1e-6), 1e-6
    for _ in range(max(epochs, -(-steps * batch // len(described)))):
        order = random.permutation(len(described))
        for start in range(0, len(order), batch):
            chosen = order[start : start + batch]
            numbers, values, starts = _joined([described[i] for i in chosen])
            found, total = model.sums(numbers, values, starts)
            error = (sigmoid(found) - labels[chosen]) / len(chosen)
            owner = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(numbers))))
            used, place = np.unique(numbers, return_inverse=True)
            slope = error[owner] * values
            grad_w = np.bincount(place, slope, len(used)) + shrink * model.weights[used]
            own = model.factors[numbers] * values[:, None]
            terms = slope[:, None] * (total[owner] - own)
            grad_v = np.stack(
                [np.bincount(place, terms[:, f], len(used)) for f in range(FACTORS)], axis=1
            )
            grad_v += shrink * model.factors[used]
            seen_w[used] += grad_w**2
            seen_v[used] += grad_v**2
            seen_b += error.sum() ** 2
            model.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
            model.factors[used] -= rate * 0.3 * grad_v / np.sqrt(seen_v[used])
            model.bias -= rate * error.sum() / np.sqrt(seen_b)
    return model.to_bytes()


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS
) -> bytes | None:
    """The machine learnt from the labelled rows that are not held out.

    ``labels`` has doc_id and the label; 1 stands for good text. Rows with
    NULL in either are passed over. None if no row is left.
    """
    sample = labelled_sample(
        docs, labels, label, lambda i: remainder(i, HELD_OUT_OF) != HELD_OUT, sample_rows
    )
    return fit_in_one_task(sample, packed, fit)


def score(
    docs: DataFrame, model: bytes | None, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per input row: id, held_out, score from 0 to 1.

    Only the text is scored, the whole of it. NULL and empty texts are scored
    by their lack of words. Without a model every score is 0.5. Repeated rows
    and NULL ids are scored like others.
    """
    machine = Machine.from_bytes(model) if model else None

    def scores(texts):
        if machine is None:
            return np.full(len(texts), 0.5)
        return machine.scores([describe(t) for t in texts])

    found = scored(docs, scores, text, doc_id)
    held_out = remainder(F.col("id"), HELD_OUT_OF) == HELD_OUT
    return found.select("id", held_out.alias("held_out"), "score")
