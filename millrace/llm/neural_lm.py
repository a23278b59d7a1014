"""Score texts with a log-bilinear language model that is trained by noise contrast.

The model predicts units. The most frequent words, and the end of a text, are
units of their own; every other word belongs to the unit of its last bytes, in
which words share by their counts. A unit's score is the product of its vector
with the sum of the vectors of the units before it, each scaled by its distance.
Matrix products over batches of tokens give the scores of all units, so the
probabilities that are reported are normalised exactly.

All counts cover all learnable texts. So does the training: each round reads its
share of them, every task trains on the texts it holds, and the tasks' models are
averaged by their tokens.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import as_bytes, quoted_col
from millrace.workspace import stage

# Units: single words, the end among them, and classes of the others.
UNIT_WORDS = 160
CLASSES = 96
SUFFIX_BYTES = 3

# The words whose counts are sent to tasks. With keys of at most KEY_BYTES they take
# at most 10 MB; the counts of all others are joined.
HEAD_WORDS = 1 << 17
KEY_BYTES = 64

CONTEXT = 3
WIDTH = 16
NOISE = 32
BATCH = 2048
RATE = 0.4
ROUNDS = 4

# Tokens whose order is shuffled in training, and whose scores, of all units, are held
# at a time; they stay in a core's cache from the product to the sums.
SHUFFLED_TOKENS = 1 << 16
SCORED_TOKENS = 1 << 11

# Bytes of texts that are scored together; a longer text is scored by itself.
SCORED_BYTES = 1 << 17

# Distinct words, and bytes of text, after which a task passes its counts on.
HELD_WORDS = 400_000
HELD_BYTES = 1 << 27

# Rows that the tasks' models are added up in before they reach the driver.
MODEL_GROUPS = 64

# Count that every word, and one unseen word of each class, has besides its own.
ADDED = 0.1

END = b""


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text with A to Z lower-cased, and the end."""
    return [*(text or b"").lower().split(), END]


def key_of(word: bytes) -> bytes:
    """The word, or a digest that no word can be, as it starts with a space."""
    return word if len(word) <= KEY_BYTES else b" " + hashlib.sha256(word).digest()


def class_of(key: bytes) -> int:
    return zlib.crc32(key[-SUFFIX_BYTES:]) % CLASSES


def count_tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """word (its key), class and c, the number of uses, of every distinct token."""

    def packed(held: Counter) -> pa.RecordBatch:
        for word in [w for w in held if len(w) > KEY_BYTES]:
            held[key_of(word)] += held.pop(word)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(held), pa.binary()),
                pa.array([class_of(word) for word in held], pa.int32()),
                pa.array(list(held.values()), pa.int64()),
            ],
            ["word", "class", "c"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0
        for batch in batches:
            for body in as_bytes(batch.column(0)):
                held.update(tokens(body))
                size += len(body or b"")
                if len(held) >= HELD_WORDS or size >= HELD_BYTES:
                    yield packed(held)
                    held, size = Counter(), 0
        if held:
            yield packed(held)

    counted = docs.select(quoted_col(text)).mapInArrow(count, "word binary, class int, c bigint")
    return counted.groupBy("word", "class").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The head of the counted words, and what is known of all of them."""

    places: dict[bytes, int]
    counts: np.ndarray
    units: np.ndarray
    n_units: int
    single: int
    total: int
    distinct: int
    unit_counts: np.ndarray
    unit_words: np.ndarray

    @cached_property
    def _units(self) -> dict[bytes, int]:
        single = self.single

        class Units(dict):
            def __missing__(self, word: bytes) -> int:
                if len(word) > KEY_BYTES:
                    return self[key_of(word)]
                return single + class_of(word)

        return Units(zip(self.places, self.units.tolist(), strict=True))

    def share(self) -> np.ndarray:
        """Smoothed probability of every unit."""
        weight = self.unit_counts + ADDED * (self.unit_words + 1)
        return weight / weight.sum()

    def units_of(self, words: Sequence[bytes]) -> np.ndarray:
        """Unit of each word."""
        return np.fromiter(map(self._units.__getitem__, words), np.int16, len(words))

    @cached_property
    def _units_by_place(self) -> np.ndarray:
        """Units of the head, and one more that stands for the place -1."""
        return np.append(self.units, 0).astype(np.int16)

    def look_up(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
        """Place in the head (-1: none) and unit of each word; keys of the words without a place."""
        get = self.places.get
        places = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        units = self._units_by_place[places]
        at = np.flatnonzero(places < 0)
        others = {i: words[i] for i in at.tolist()}
        long = {i: key_of(word) for i, word in others.items() if len(word) > KEY_BYTES}
        others |= long
        units[at] = self.single + np.fromiter(map(class_of, others.values()), np.int64, len(at))
        for i, key in long.items():
            place = get(key, -1)
            if place >= 0:
                places[i], units[i] = place, self._units_by_place[place]
                del others[i]
        return places, units, others


def read_vocabulary(counts: DataFrame) -> Vocabulary:
    """The vocabulary of staged counts.

    The head is found by a histogram of counts in steps of about one percent, so it
    has at most ``HEAD_WORDS`` words and the end, and no task sorts all words.
    """
    step = F.floor(F.log2("c") * 64)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    room, least = HEAD_WORDS, None
    for row in sorted(steps, reverse=True):
        room -= row["n"]
        if room < 0:
            break
        least = row["step"]
    chosen = F.col("word") == F.lit(END)
    if least is not None:
        chosen = chosen | (step >= least)
    head = sorted((-r["c"], bytes(r["word"]), r["class"]) for r in counts.where(chosen).collect())
    classes = counts.where(F.col("word") != F.lit(END)).groupBy("class").agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")
    )
    # The end is a unit even if nothing was counted.
    words = [END, *[word for _, word, _ in head if word != END]]
    by_word = {word: (-c, kind) for c, word, kind in head}
    single = min(UNIT_WORDS, len(words))
    unit_counts = np.zeros(single + CLASSES)
    unit_words = np.zeros(single + CLASSES)
    for row in classes.collect():
        unit_counts[single + row["class"]] = row["c"]
        unit_words[single + row["class"]] = row["n"]
    total = int(unit_counts.sum()) + by_word.get(END, (0, 0))[0]
    distinct = int(unit_words.sum()) + (END in by_word)
    units = np.empty(len(words), np.int64)
    for place, word in enumerate(words):
        c, kind = by_word.get(word, (0, 0))
        units[place] = place if place < single else single + kind
        if place < single:
            unit_counts[place] = c
            if word != END:
                unit_counts[single + kind] -= c
                unit_words[single + kind] -= 1
    return Vocabulary(
        places={word: place for place, word in enumerate(words)},
        counts=np.array([by_word.get(word, (0, 0))[0] for word in words], np.int64),
        units=units,
        n_units=single + CLASSES,
        single=single,
        total=total,
        distinct=distinct,
        unit_counts=unit_counts,
        unit_words=unit_words,
    )


def _sum_rows(places: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each place, as a matrix of ``n`` rows.

    Places may be several times as many as rows, which then repeat.
    """
    order = np.argsort(places, kind="stable")
    ordered = places[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    if len(places) > len(rows):
        order %= len(rows)
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[ordered[starts]] = np.add.reduceat(rows.take(order, axis=0), starts, axis=0)
    return out


def contexts(units: np.ndarray, sizes: Sequence[int], begin: int) -> np.ndarray:
    """The units before each token of texts that follow one another, nearest first."""
    sizes = np.asarray(sizes, np.int64)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(units))
    found = np.full((CONTEXT, len(units)), begin, np.int16)
    for back in range(1, CONTEXT + 1):
        inside = at - back >= starts
        found[back - 1, inside] = units[(at - back)[inside]]
    return found


@dataclass
class Model:
    """Vectors of units as context (the last one stands before a text) and as prediction."""

    context: np.ndarray
    scale: np.ndarray
    predicted: np.ndarray
    bias: np.ndarray
    steps: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def start(cls, share: np.ndarray) -> Model:
        """Small fixed random vectors, and the units' own shares."""
        picker = np.random.default_rng(20260301)
        n = len(share)
        model = cls(
            picker.normal(0, 0.3, (n + 1, WIDTH)).astype(np.float32),
            np.full((CONTEXT, WIDTH), CONTEXT**-0.5, np.float32),
            picker.normal(0, 0.3, (n, WIDTH)).astype(np.float32),
            np.log(share).astype(np.float32),
        )
        model.steps = [np.full_like(part, 1e-3) for part in model.parts()]
        return model

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.scale, self.predicted, self.bias]

    def packed(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in (*self.parts(), *self.steps)])

    def unpacked(self, numbers: np.ndarray) -> Model:
        """A model of this shape with other numbers."""
        shaped, at = [], 0
        for part in (*self.parts(), *self.steps):
            shaped.append(numbers[at : at + part.size].reshape(part.shape).astype(np.float32))
            at += part.size
        return Model(*shaped[:4], steps=shaped[4:])

    def hidden(self, before: np.ndarray) -> np.ndarray:
        """The sum of the scaled vectors of each token's context."""
        scaled = self.context * self.scale[:, None]
        out = scaled[0].take(before[0], axis=0)
        for back in range(1, CONTEXT):
            out += scaled[back].take(before[back], axis=0)
        return out

    def learn(self, before: np.ndarray, unit: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> None:
        """One step of ascent: tell each token's unit from the noise, which the batch shares.

        ``log_noise`` is the logarithm of how many of a token's noise units are
        expected to be each unit.
        """
        n, width, units = len(unit), self.predicted.shape[1], len(self.context)
        hidden, own, others = self.hidden(before), self.predicted.take(unit, axis=0), self.predicted[noise]
        offset = self.bias - log_noise
        # What is left to gain for the tokens, and to lose for the noise.
        gain = (hidden * own).sum(axis=1) + offset.take(unit)
        gain = 1 / (1 + np.exp(np.clip(gain, -30, 30)))
        lose = hidden @ others.T
        lose += offset[noise]
        np.clip(lose, -30, 30, out=lose)
        np.exp(-lose, out=lose)
        lose += 1
        np.divide(-1, lose, out=lose)
        toward = gain[:, None] * own
        toward += lose @ others
        # The bias is the last column of the predicted vectors' sums.
        rows = np.empty((n, width + 1), np.float32)
        np.multiply(hidden, gain[:, None], out=rows[:, :width])
        rows[:, width] = gain
        sums = _sum_rows(unit, rows, len(self.bias))
        np.add.at(sums, noise, np.column_stack([lose.T @ hidden, lose.sum(axis=0)]))
        sums /= n
        spread = (before + (np.arange(CONTEXT, dtype=np.int16) * units)[:, None]).ravel()
        met = _sum_rows(spread, toward, CONTEXT * units).reshape(CONTEXT, units, width)
        met /= n
        changes = [
            (met * self.scale[:, None]).sum(axis=0),
            (met * self.context).sum(axis=1),
            sums[:, :width],
            sums[:, width],
        ]
        for part, step, change in zip(self.parts(), self.steps, changes, strict=True):
            step += change * change
            part += RATE * change / np.sqrt(step)

    def log10_probabilities(self, before: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each unit after its context."""
        out = np.empty(len(unit))
        predicted = np.column_stack([self.predicted, self.bias]).T.copy()
        ones = np.ones(len(self.bias), np.float32)
        longest = np.sqrt((predicted * predicted).sum(axis=0).max())
        for at in range(0, len(unit), SCORED_TOKENS):
            here = slice(at, at + SCORED_TOKENS)
            hidden = self.hidden(before[:, here])
            hidden = np.column_stack([hidden, np.ones(len(hidden), np.float32)])
            scores = hidden @ predicted
            own = scores[np.arange(len(scores)), unit[here]].astype(float)
            highest = np.zeros(len(scores))
            # Only scores far above what training gives need to be lowered first.
            if np.sqrt((hidden * hidden).sum(axis=1).max()) * longest > 60:
                highest = scores.max(axis=1).astype(float)
                scores -= highest[:, None].astype(np.float32)
            np.exp(scores, out=scores)
            out[here] = own - highest - np.log((scores @ ones).astype(float))
        return out / np.log(10)


@dataclass
class LanguageModel:
    vocabulary: Vocabulary
    model: Model
    counts: DataFrame


def _batches_of_units(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, most: int
) -> Iterator[tuple[np.ndarray, list[int]]]:
    words, sizes = [], []
    for batch in batches:
        for body in as_bytes(batch.column(0)):
            found = tokens(body)
            words += found
            sizes.append(len(found))
            if len(words) >= most:
                yield vocabulary.units_of(words), sizes
                words, sizes = [], []
    if words:
        yield vocabulary.units_of(words), sizes


def _trained_once(texts: DataFrame, vocabulary: Vocabulary, model: Model, number: int) -> Model:
    """The average, by tokens, of what tasks make of a model with the texts that they hold."""
    share = vocabulary.share()
    reach = np.cumsum(share)
    log_noise = np.log(NOISE * share).astype(np.float32)
    begin = vocabulary.n_units
    start = model.packed()

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own, seen = TaskContext.get().partitionId(), model.unpacked(start.copy()), 0
        picker = np.random.default_rng([number, place])
        for units, sizes in _batches_of_units(batches, vocabulary, SHUFFLED_TOKENS):
            before, order = contexts(units, sizes, begin), picker.permutation(len(units))
            for at in range(0, len(order), BATCH):
                chosen = order[at : at + BATCH]
                noise = np.searchsorted(reach, picker.random(NOISE) * reach[-1]).clip(0, len(share) - 1)
                own.learn(before[:, chosen], units[chosen], noise, log_noise)
            seen += len(units)
        if seen:
            columns = [pa.array([place]), pa.array([seen]), pa.array([own.packed().tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["place", "seen", "model"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In a fixed order, so that reruns give the same sums.
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        if rows:
            total = sum(seen * np.frombuffer(body, np.float32).astype(float) for _, seen, body in rows)
            columns = [[rows[0][0]], [sum(r[1] for r in rows)], [total.tobytes()]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["place", "seen", "model"])

    schema = "place bigint, seen bigint, model binary"
    trained = texts.mapInArrow(train, schema).repartition(MODEL_GROUPS, "place")
    rows = sorted(tuple(r) for r in trained.mapInArrow(add_up, schema).collect())
    if not rows:
        return model
    total = sum(np.frombuffer(bytes(body)) for _, _, body in rows)
    return model.unpacked(total / sum(seen for _, seen, _ in rows))


def train(
    docs: DataFrame,
    learnable: Callable[[Column], Column] = lambda doc_id: F.lit(True),
    text: str = "text",
    doc_id: str = "doc_id",
    rounds: int = ROUNDS,
) -> LanguageModel:
    """A model of the texts of the rows whose id ``learnable`` accepts.

    NULL and empty texts are an end without words; repeated rows count anew. Each
    learnable text is counted once and trained on in one round, chosen by a hash
    of its id. No learnable rows give a model that knows nothing and calls all
    units alike.
    """
    rows = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    rows = rows.where(F.coalesce(learnable(F.col("id")), F.lit(False)))
    counts = stage(count_tokens(rows), "token-counts", measure=[]).df
    vocabulary = read_vocabulary(counts)
    model = Model.start(vocabulary.share())
    for number in range(rounds):
        own = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(rounds)) == number
        model = _trained_once(rows.where(own).select("text"), vocabulary, model, number)
    return LanguageModel(vocabulary, model, counts)


def score(docs: DataFrame, language: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, n_tokens, n_known, base_score and score.

    ``score`` is the model's log10 probability of the words and the end of the
    text, ``base_score`` that of the counts alone. Words beyond the head are
    joined with the counts of all words, once per text and word.
    """
    vocabulary, model = language.vocabulary, language.model
    rows = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    floor = np.log10(vocabulary.total + ADDED * (vocabulary.distinct + 1))
    room = np.log10(vocabulary.unit_counts + ADDED * (vocabulary.unit_words + 1))
    logs = np.log10(vocabulary.counts + ADDED)
    pair = pa.struct([("word", pa.binary()), ("n", pa.int64())])
    names = ["row", "id", "n_tokens", "n_known", "base_score", "score", "others"]

    def score_texts(ids: pa.Array, bodies: list, row: int) -> pa.RecordBatch:
        found = [tokens(body) for body in bodies]
        sizes = np.array([len(words) for words in found])
        places, units, beyond = vocabulary.look_up([word for words in found for word in words])
        inside = places >= 0
        log_count = np.where(inside, logs[places], 0)
        known = inside & (vocabulary.counts[places] > 0)
        chances = model.log10_probabilities(contexts(units, sizes, vocabulary.n_units), units)
        # Within a class a word's share is its count by the class's.
        chances += np.where(units >= vocabulary.single, log_count - room[units], 0)
        starts = np.cumsum(sizes) - sizes
        add = lambda values: np.add.reduceat(values, starts)
        others = [[] for _ in found]
        texts = np.repeat(np.arange(len(sizes)), sizes)[list(beyond)]
        counted = Counter(zip(texts.tolist(), beyond.values(), strict=True))
        for (number, word), n in counted.items():
            others[number].append({"word": word, "n": n})
        columns = [
            pa.array(np.arange(row, row + len(sizes))),
            ids,
            pa.array(sizes),
            pa.array(add(known.astype(np.int64))),
            pa.array(add(log_count) - sizes * floor),
            pa.array(add(chances)),
            pa.array(others, pa.list_(pair)),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            bodies, at, size = as_bytes(batch.column(1)), 0, 0
            for end, body in enumerate(bodies, 1):
                size += len(body or b"")
                if size >= SCORED_BYTES or end == len(bodies):
                    yield score_texts(batch.column(0).slice(at, end - at), bodies[at:end], row)
                    row, at, size = row + end - at, end, 0

    schema = (
        f"row bigint, id {kind}, n_tokens bigint, n_known bigint, base_score double, score double, "
        "others array<struct<word: binary, n: bigint>>"
    )
    # Staged, so that a row keeps its number even if a task is run again.
    scored = stage(rows.mapInArrow(run, schema), "scored", measure=[]).df
    seen = scored.select("row", F.inline("others")).join(
        language.counts.select("word", "c"), "word", "left"
    )
    more = seen.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADDED))).alias("more"),
    )
    extra = F.coalesce("more", F.lit(0.0))
    return scored.join(more, "row", "left").select(
        "id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + extra).alias("base_score"),
        (F.col("score") + extra).alias("score"),
    )
