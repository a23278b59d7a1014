"""The language model: counts, exact normalisation, gradients and whole results."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import neural_lm
from millrace.llm.queries import QUERIES
from tests.llm.support import awkward, awkward_rows, nothing, prose


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lowered), ""]


def counted(texts):
    counts = Counter()
    for text in texts:
        counts.update(words_of(text))
    return counts


def base(text, counts):
    total, distinct = sum(counts.values()), len(counts)
    return sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words_of(text))


def test_query_equals_brute_force_and_beats_the_counts(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 10 == 0}
    counts = counted(text for i, text in docs.items() if i not in held)
    rows = QUERIES["op13_language_model"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    gained = []
    for r in rows:
        words = words_of(docs[r.doc_id])
        assert (r.held_out, r.n_tokens) == (r.doc_id in held, len(words))
        assert (r.n_known, r.train_tokens) == (sum(w in counts for w in words), sum(counts.values()))
        assert r.base_score == pytest.approx(base(docs[r.doc_id], counts), rel=1e-9)
        assert r.score < 0
        if r.held_out:
            gained.append((r.score - r.base_score) / r.n_tokens)
    assert np.mean(gained) > 0


@pytest.fixture(scope="module")
def small(spark):
    texts = [(i, prose(i % 5, 60 + i)) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    return docs, neural_lm.train(docs)


def test_probabilities_of_all_next_words_sum_to_one(small):
    docs, language = small
    v, model = language.vocabulary, language.model
    counts = {bytes(r.word): (r["class"], r.c) for r in language.counts.collect()}
    assert sum(c for _, c in counts.values()) == v.total and len(counts) == v.distinct
    before = np.array([[1, v.n_units], [2, v.n_units], [3, v.n_units]], np.int16)
    every = np.repeat(before[:, :1], v.n_units, axis=1)
    units = np.arange(v.n_units, dtype=np.int16)
    chances = 10 ** model.log10_probabilities(every, units)
    assert chances.sum() == pytest.approx(1, abs=1e-5)
    # Within a class the words and one unseen word share all of it.
    room = v.unit_counts + neural_lm.ADDED * (v.unit_words + 1)
    total = chances[: v.single].sum()
    for word, (kind, c) in counts.items():
        assert kind == neural_lm.class_of(word)
        if v.places.get(word, v.single) >= v.single:
            total += chances[v.single + kind] * (c + neural_lm.ADDED) / room[v.single + kind]
    unseen = sum(chances[v.single + k] * neural_lm.ADDED / room[v.single + k] for k in range(neural_lm.CLASSES))
    assert total + unseen == pytest.approx(1, abs=1e-5)


def test_scores_are_the_sums_over_tokens_however_words_are_looked_up(spark, small, monkeypatch):
    docs, language = small
    want = {r.id: (r.base_score, r.score, r.n_known) for r in neural_lm.score(docs, language).collect()}
    v = language.vocabulary
    for r in docs.collect():
        found = neural_lm.tokens(r.text.encode())
        units = v.units_of(found)
        _, looked, _ = v.look_up(found)
        assert (looked == units).all()
    # With a head of a few words the others are joined, and nothing changes.
    monkeypatch.setattr(neural_lm, "HEAD_WORDS", v.single + 5)
    shorter = neural_lm.read_vocabulary(language.counts)
    assert len(shorter.places) < len(v.places) and shorter.total == v.total
    again = neural_lm.LanguageModel(shorter, language.model, language.counts)
    if shorter.n_units == v.n_units:
        got = {r.id: (r.base_score, r.score, r.n_known) for r in neural_lm.score(docs, again).collect()}
        assert all(got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_a_step_follows_the_gradient():
    picker = np.random.default_rng(0)
    share = np.array([0.4, 0.3, 0.2, 0.1])
    model = neural_lm.Model.start(share)
    before = picker.integers(0, 5, (neural_lm.CONTEXT, 6)).astype(np.int16)
    unit = picker.integers(0, 4, 6).astype(np.int16)
    noise, log_noise = np.array([0, 1, 1]), np.log(3 * share).astype(np.float32)

    def gain(m):
        hidden = m.hidden(before).astype(float)
        own = (hidden * m.predicted[unit]).sum(1) + (m.bias - log_noise)[unit]
        others = hidden @ m.predicted[noise].T + (m.bias - log_noise)[noise]
        return (-np.log1p(np.exp(-own)) - np.log1p(np.exp(others)).sum(1)).mean()

    start = model.packed()
    moved = model.unpacked(start.copy())
    moved.learn(before, unit, noise, log_noise)
    for part, after, step in zip(model.parts(), moved.parts(), moved.steps, strict=True):
        flat, change = part.ravel(), (after - part).ravel()
        # What was added to the squares shows the size of each derivative.
        size = np.sqrt(np.maximum(step.ravel() - 1e-3, 0))
        for i in picker.choice(len(flat), min(len(flat), 12), replace=False):
            old, eps = flat[i], 1e-2
            flat[i] = old + eps
            up = gain(model)
            flat[i] = old - eps
            down = gain(model)
            flat[i] = old
            slope = (up - down) / (2 * eps)
            assert size[i] == pytest.approx(abs(slope), abs=2e-3)
            assert abs(slope) < 1e-3 or np.sign(change[i]) == np.sign(slope)
    assert gain(moved) > gain(model)


def test_scores_that_are_held_at_a_time_are_few_and_their_number_changes_nothing(small, monkeypatch):
    _, language = small
    model, n = language.model, language.vocabulary.n_units
    most = 4 * neural_lm.SCORED_TOKENS * (neural_lm.UNIT_WORDS + neural_lm.CLASSES)
    assert most <= 1 << 21
    picker = np.random.default_rng(0)
    before = picker.integers(0, n, (neural_lm.CONTEXT, 500)).astype(np.int16)
    unit = picker.integers(0, n, 500).astype(np.int16)
    want = model.log10_probabilities(before, unit)
    monkeypatch.setattr(neural_lm, "SCORED_TOKENS", 7)
    assert model.log10_probabilities(before, unit) == pytest.approx(want, abs=1e-5)


def test_places_and_units_of_words_in_and_beyond_the_head():
    long, far = b"x" * 100, b"y" * 100
    words = [neural_lm.END, b"a", neural_lm.key_of(long), b"bc"]
    kinds = [neural_lm.class_of(word) for word in words]
    units = np.array([0, 1, 2 + kinds[2], 2 + kinds[3]])
    places = {word: place for place, word in enumerate(words)}
    some = np.ones(2 + neural_lm.CLASSES)
    v = neural_lm.Vocabulary(places, np.ones(4), units, len(some), 2, 4, 4, some, some)
    asked = [b"bc", long, b"other", far, b"", b"a", b"other"]
    found, looked, others = v.look_up(asked)
    assert found.tolist() == [3, 2, -1, -1, 0, 1, -1]
    assert others == {2: b"other", 3: neural_lm.key_of(far), 6: b"other"}
    class_of = lambda word: 2 + neural_lm.class_of(neural_lm.key_of(word))
    assert looked.tolist() == [class_of(b"bc"), class_of(long), class_of(b"other"), class_of(far), 0, 1, class_of(b"other")]
    assert v.units_of(asked).tolist() == looked.tolist()


def test_reruns_agree(spark, small):
    docs, language = small
    again = neural_lm.train(docs)
    assert (again.model.packed() == language.model.packed()).all()


def test_awkward_rows(spark):
    docs = awkward(spark)
    language = neural_lm.train(docs, lambda i: i.isNotNull(), rounds=2)
    counts = counted(r[1] for r in awkward_rows() if r[0] is not None)
    rows = neural_lm.score(docs, language).collect()
    assert sorted(map(repr, ((r.id, r.n_tokens) for r in rows))) == sorted(
        repr((r[0], len(words_of(r[1])))) for r in awkward_rows())
    want = Counter((r[0], round(base(r[1], counts), 6)) for r in awkward_rows())
    assert Counter((r.id, round(r.base_score, 6)) for r in rows) == want


def test_nothing_to_learn_from(spark):
    language = neural_lm.train(nothing(spark), rounds=1)
    assert neural_lm.score(nothing(spark), language).collect() == []
    rows = neural_lm.score(spark.createDataFrame([(1, "a b")], "doc_id int, text string"), language).collect()
    assert [(r.n_tokens, r.n_known, round(r.base_score, 9)) for r in rows] == [(3, 0, 0.0)]
    assert rows[0].score < 0


def test_long_words_are_told_apart(spark):
    long = "x" * 100
    docs = spark.createDataFrame([(1, f"{long} {long} {long}y"), (2, f"{long}z a")], "doc_id int, text string")
    language = neural_lm.train(docs, lambda i: i == 1, rounds=1)
    rows = {r.id: r for r in neural_lm.score(docs, language).collect()}
    assert (rows[1].n_known, rows[2].n_known, language.vocabulary.distinct) == (4, 1, 3)


def test_counts_do_not_depend_on_when_tasks_pass_them_on(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i % 3, 100)) for i in range(9)], "doc_id int, text string")
    want = sorted(map(tuple, neural_lm.count_tokens(docs).collect()))
    monkeypatch.setattr(neural_lm, "HELD_WORDS", 3)
    assert sorted(map(tuple, neural_lm.count_tokens(docs).collect())) == want
