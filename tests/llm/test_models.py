from __future__ import annotations

import itertools
import zlib

import numpy as np
from support import LONG, awkward, awkward_rows, nothing, prose

from millrace.llm import quality_model, toxicity
from millrace.llm.labelled import labelled_sample, remainder

RUDE = ["blorf", "znarky", "quibbad"]


def labelled(spark):
    rows, labels = [], []
    for i in range(240):
        text = prose(i, 60 + i % 40)
        if i % 4 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if i % 6 == 1:
            words = text.split()
            words[10:10] = [RUDE[i % 3], RUDE[(i + 1) % 3]]
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(i % 4 != 0), int(i % 6 == 1)))
    labels += [(None, 1, 1), (3, None, None), (10_000, 1, 0)]
    return (
        spark.createDataFrame(rows, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        {i: (q, t) for i, q, t in labels},
    )


def test_pair_sum_in_linear_time_equals_all_pairs():
    random = np.random.default_rng(0)
    machine = quality_model.Machine(
        0.3, random.normal(size=quality_model.FEATURES),
        random.normal(size=(quality_model.FEATURES, quality_model.FACTORS)),
    )
    numbers, values = quality_model.describe(b"some words of a text, some WORDS")
    found, _ = machine.sums(numbers, values, np.array([0]))
    want = 0.3 + machine.weights[numbers] @ values
    for i, j in itertools.combinations(range(len(numbers)), 2):
        want += machine.factors[numbers[i]] @ machine.factors[numbers[j]] * values[i] * values[j]
    assert np.isclose(found[0], want)


def test_held_out_rows_are_told_apart(spark):
    docs, labels, truth = labelled(spark)
    for module, place in ((quality_model, 0), (toxicity, 1)):
        rows = module.score(docs, module.train(docs, labels)).collect()
        held = [r for r in rows if r.held_out and r.id != 3]
        assert len(held) > 20
        right = sum((r.score >= 0.3) == truth[r.id][place] for r in held)
        assert right >= 0.93 * len(held)


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = labelled(spark)
    for module, column in ((quality_model, "quality"), (toxicity, "toxic")):
        out = remainder(labels["doc_id"], module.HELD_OUT_OF) == module.HELD_OUT
        changed = labels.withColumn(column, (1 - labels[column]) * out.cast("int") + labels[column] * (1 - out.cast("int")))
        assert module.train(docs, labels) == module.train(docs, changed)


def test_remainder_is_of_the_id_as_text(spark):
    df = spark.createDataFrame([(i,) for i in (0, 7, 123456)], "doc_id bigint")
    got = df.select("doc_id", remainder(df["doc_id"], 5).alias("r")).collect()
    assert {r.doc_id: r.r for r in got} == {i: zlib.crc32(str(i).encode()) % 5 for i in (0, 7, 123456)}


def test_awkward_rows_empty_tables_and_no_labels(spark):
    docs, labels, _ = labelled(spark)
    none = labels.limit(0)
    for module in (quality_model, toxicity):
        model = module.train(docs, labels)
        got = module.score(awkward(spark), model).collect()
        assert sorted(map(str, (r.id for r in got))) == sorted(str(r[0]) for r in awkward_rows())
        assert all(0 <= r.score <= 1 for r in got)
        assert module.score(nothing(spark), model).count() == 0
        assert module.train(docs, none) is None
        assert {r.score for r in module.score(docs, None).collect()} == {0.5}


def test_the_sample_is_bounded_in_rows_however_often_ids_repeat(spark):
    docs, labels, _ = labelled(spark)
    repeated = docs.unionByName(docs.where("doc_id < 40").withColumn("text", docs["text"].substr(1, 50)))
    repeated = repeated.unionByName(docs.where("doc_id = 8").crossJoin(spark.range(3000)).drop("id"))
    sample = labelled_sample(repeated, labels, "quality", lambda i: i >= 0, 10)
    rows = sample.collect()
    assert len(rows) == 10 and len({r.id for r in rows}) == 10
    whole = labelled_sample(repeated, labels, "quality", lambda i: i == 8, 10).collect()
    text = docs.where("doc_id = 8").first().text
    assert [(r.id, r.text, r.label) for r in whole] == [(8, min(text, text[:50]), 0)]
    # Repeated rows of one text change nothing.
    plain = labelled_sample(docs, labels, "quality", lambda i: i >= 0, 50).collect()
    twice = labelled_sample(docs.unionByName(docs), labels.unionByName(labels), "quality", lambda i: i >= 0, 50)
    assert sorted(map(tuple, plain)) == sorted(map(tuple, twice.collect()))


def test_whole_texts_are_scored():
    grams = toxicity.GramSet()
    assert set(grams((LONG + " blorf").encode())) > set(grams(LONG.encode()))


def ngrams(text):
    """The distinct n-grams of a text, one character after another."""
    body = f" {' '.join(''.join(chr(ord(c) + 32) if 'A' <= c <= 'Z' else c for c in text).split(' '))} "
    return {body[i : i + n] for n in toxicity.GRAMS for i in range(len(body) - n + 1)}


def test_grams_are_of_characters_and_scores_are_their_sums(spark):
    grams = toxicity.GramSet()
    # Two bytes each, but one character.
    assert len(grams("éà".encode())) == len(ngrams("éà")) == 1
    text = "Übel RIECHENDE ﬁsche – ja"
    assert len(grams(text.encode())) == len(ngrams(text))
    assert set(grams("a É".encode())) != set(grams("a é".encode()))
    texts = ["blorf now", "so nice", "nice blorf", "very nice day", "znarky blorf"]
    labels = np.array([1.0, 0, 1, 0, 1])
    ratios, counts = toxicity.log_count_ratios([grams(t.encode()) for t in texts], labels)
    for gram in ngrams("nice blorf"):
        place = grams(gram.encode())
        inside = [gram in ngrams(t) for t in texts]
        if len(gram) == max(toxicity.GRAMS) and not gram.startswith(" ") and not gram.endswith(" "):
            # The gram's own place is among those of the text that holds it.
            number = set(grams(f"{gram}".encode())) & set(grams(b"nice blorf"))
            assert number
        toxic = 1 + sum(i for i, label in zip(inside, labels, strict=True) if label)
        other = 1 + sum(i for i, label in zip(inside, labels, strict=True) if not label)
        want = np.log(toxic / (labels.sum() + 2)) - np.log(other / ((1 - labels).sum() + 2))
        assert np.isclose(ratios, want).any() and len(place)
    docs, truth, _ = labelled(spark)
    model = toxicity.train(docs, truth)
    import io

    parts = np.load(io.BytesIO(model))
    for row in toxicity.score(docs.limit(20), model).collect():
        body = docs.where(docs["doc_id"] == row.id).first().text
        total = float(parts["bias"]) + sum(float(parts["table"][g]) for g in set(grams(body.encode()).tolist()))
        assert np.isclose(row.score, 1 / (1 + np.exp(-total)), rtol=1e-4)
