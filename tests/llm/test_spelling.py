"""Spelling variants against all pairs of words, and the choice of pivots."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import spelling
from millrace.llm.queries import QUERIES
from tests.llm.support import awkward, nothing, prose


def one_edit(a, b):
    """Whether exactly one character is inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted(rows, modulus=None):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if modulus and h % modulus == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def neighbours(words):
    """Near words of each word, found by the words with one character left out."""
    holes = {}
    for word in words:
        for i in range(len(word)):
            holes.setdefault((word[:i], word[i + 1 :]), set()).add(word)
            if word[:i] + word[i + 1 :] in words:
                holes.setdefault(("", word[:i] + word[i + 1 :], ""), set()).update(
                    (word, word[:i] + word[i + 1 :])
                )
    near = {word: set() for word in words}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    return near


def plain(words, near=None, ratio=5):
    near = near or {a: {b for b in words if one_edit(a, b)} for a in words}
    forms = {}
    for a, n in words.items():
        best = min(near[a], key=lambda b: (-words[b], b.encode()), default=None)
        if best is not None and words[best] >= ratio * n:
            forms[a] = best
    out = []
    for a, n in words.items():
        root = a
        while root in forms:
            root = forms[root]
        form = forms.get(a)
        out.append((a, form, root, n, len(near[a]), words.get(form)))
    return sorted(out, key=repr)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    words = counted(rows, 199)
    got = collected(QUERIES["op12_spelling_variants"](spark, sf_dir))
    assert got == plain(words, neighbours(words))
    assert any(r[1] for r in got)


@pytest.mark.parametrize("seed", range(4))
def test_all_pairs_of_words_of_few_letters(spark, seed):
    picker = random.Random(seed)
    letters = ["ab", "abcé", "abÿ×"][seed % 3]
    words = {}
    while len(words) < 250:
        words["".join(picker.choices(letters, k=picker.randint(6, 9)))] = picker.choice([5, 6, 25, 30, 150, 1000])
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert collected(spelling.group_variants(frame)) == plain(words)


def test_every_single_edit_of_a_word_is_found(spark):
    word = "réunification"
    edits = {word[:i] + word[i + 1 :] for i in range(len(word))}
    edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in "xé"}
    edits |= {word[:i] + "w" + word[i + 1 :] for i in range(len(word))}
    frame = spark.createDataFrame([(w, 5) for w in edits - {word}] + [(word, 1000)], "word string, n bigint")
    rows = spelling.group_variants(frame).collect()
    assert all(r.form == word and r.root == word and r.form_n == 1000 for r in rows if r.word != word)
    assert next(r for r in rows if r.word == word).n_near == len(edits - {word})


def test_chains_of_forms_lead_to_the_last(spark):
    chain = [("aaaaaa" + "b" * i, 5 ** (i + 1)) for i in range(9)]
    frame = spark.createDataFrame(chain, "word string, n bigint")
    assert {r.root for r in spelling.group_variants(frame).collect()} == {chain[-1][0]}


def test_ties_take_the_smallest_word_in_code_points(spark):
    frame = spark.createDataFrame([("wordéd", 50), ("wordzd", 50), ("wordxd", 5)], "word string, n bigint")
    assert {r.word: r.form for r in spelling.group_variants(frame).collect()}["wordxd"] == "wordzd"


def test_pivots_do_not_overlap_and_weigh_least():
    picker = random.Random(5)
    for _ in range(500):
        places = sorted(picker.sample(range(12), picker.randint(3, 8)))
        grams = [(i, p) for i, p in enumerate(places)]
        weights = [picker.randint(1, 50) for _ in grams]
        pairs = [(weights[i] + weights[j]) for i, j in itertools.combinations(range(len(grams)), 2)
                 if places[j] - places[i] >= 2]
        i, j = spelling.pivots(grams, weights)
        assert places[j] - places[i] >= 2 and weights[i] + weights[j] == min(pairs)


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert collected(spelling.spelling_variants(docs)) == plain(counted(rows))
    garbled = spelling.spelling_variants(docs, garble=spelling.one_typo_in(7))
    assert collected(garbled) == plain(counted(rows, 7))


def test_a_run_of_very_many_letters(spark):
    long = "Abcdefgh" * 20_000
    text = " ".join([long] * 5 + [long + "x"] * 30)
    got = collected(spelling.spelling_variants(spark.createDataFrame([(1, text)], "doc_id int, text string")))
    assert [(len(r[0]), r[1] and len(r[1]), r[3], r[4]) for r in got] == [(160_000, 160_001, 5, 1), (160_001, None, 30, 1)]


def test_no_documents_and_no_words(spark):
    assert spelling.spelling_variants(nothing(spark)).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, "a b c")], "doc_id int, text string")).collect() == []


def test_counts_do_not_depend_on_when_tasks_pass_them_on(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i % 3, 200)) for i in range(9)], "doc_id int, text string")
    want = collected(spelling.count_words(docs))
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    assert collected(spelling.count_words(docs)) == want and want


def test_a_form_is_more_frequent(spark):
    with pytest.raises(ValueError, match="more frequent"):
        spelling.group_variants(nothing(spark).selectExpr("text AS word", "doc_id AS n"), ratio=1)
