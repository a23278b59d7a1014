"""Group spelling variants: words that differ by one inserted, deleted or replaced character.

Every word picks, of its rarest bigrams, two that do not overlap: its pivots. One
edit destroys at most one of them. Of two words that are one edit apart, the one
whose rarest bigrams are rarer over all has a pivot among the rarest bigrams of
the other. So pivots are joined with the other words' rarest bigrams, at the
places that one edit allows and beside a half of the word that it leaves alone,
and what meets is compared.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import quoted_col
from millrace.workspace import stage

# The characters of a word.
LETTERS = "A-Za-zÀ-ÿ"

MIN_LENGTH = 6
MIN_COUNT = 5
# How much more frequent a word's form has to be.
FORM_RATIO = 5

# Characters of a gram, edits that words are apart, and what follows from them:
# one edit destroys at most GRAM neighbouring grams, so of one more the last is
# shared, and among these there are always EDITS + 1 that do not overlap.
GRAM = 2
EDITS = 1
PREFIX_GRAMS = GRAM * EDITS + 1
PIVOTS = EDITS + 1

# Distinct words and characters that a task counts before it passes them on.
HELD_WORDS = 200_000
HELD_CHARS = 16_000_000

# How the other word's length and the place of a shared gram in it may differ:
# the gram stands before the edit, where places are equal, or behind it.
SHIFTS = [(0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)]

Garble = Callable[[bytes, Sequence[str]], Iterator[str]]


def one_typo_in(modulus: int) -> Garble:
    """Delete a character of those runs whose CRC-32 with the document's id the modulus divides."""

    def garble(doc_id: bytes, runs: Sequence[str]) -> Iterator[str]:
        start = zlib.crc32(doc_id + b":")
        for run in runs:
            h = zlib.crc32(run.encode(), start)
            if h % modulus == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            yield run

    return garble


def count_words(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    garble: Garble | None = None,
) -> DataFrame:
    """word and n of every distinct run of letters that is long and frequent enough.

    Only A to Z are lower-cased. ``garble`` may change the runs of a document
    (it gets the id as text, empty for NULL, and the distinct runs).
    """
    # A word is no longer than its run, so shorter runs need not be found.
    run = re.compile(f"[{LETTERS}]{{{min_length},}}")
    rows = docs.select(
        F.coalesce(quoted_col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.coalesce(quoted_col(text), F.lit("")).alias("text"),
    )

    def packed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = Counter(), 0
        for batch in batches:
            for number, body in zip(*batch.columns, strict=True):
                lowered = body.as_py().encode().lower().decode()
                found = Counter(run.findall(lowered))
                words = garble(number.as_py().encode(), found) if garble else found
                for word, n in zip(words, found.values(), strict=True):
                    if len(word) >= min_length:
                        if word not in held:
                            chars += len(word)
                        held[word] += n
                if len(held) >= HELD_WORDS or chars >= HELD_CHARS:
                    yield packed(held)
                    held, chars = Counter(), 0
        if held:
            yield packed(held)

    counted = rows.mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def pivots(grams: Sequence[tuple[int, int]], weights: Sequence[int], wanted: int = PIVOTS) -> list[int]:
    """Indexes of ``wanted`` grams that do not overlap, of the least total weight.

    ``grams`` are (rank, place) in the order of their places. The cheapest
    choice of k among the first j either leaves out the j-th or takes it with
    the cheapest k - 1 among those that end before it starts.
    """
    none = (float("inf"), ())
    best = [[(0, ())] * (len(grams) + 1)] + [[none] * (len(grams) + 1) for _ in range(wanted)]
    for j, (_, place) in enumerate(grams, 1):
        before = sum(p + GRAM <= place for _, p in grams[:j])
        for k in range(1, wanted + 1):
            cost, chosen = best[k - 1][before]
            best[k][j] = min(best[k][j - 1], (cost + weights[j - 1], (*chosen, j - 1)))
    return list(best[wanted][-1][1])


def halves(word: str, length: int) -> tuple[bytes, bytes]:
    """What one edit between words of the word's and of this length leaves alone, one or the other."""
    shorter = min(len(word), length)
    first = shorter // 2
    return word[:first].encode(), word[len(word) - (shorter - first) :].encode()


def _meetings(word: str, lengths: Sequence[tuple[int, int]], grams: Sequence[tuple[int, int]], own: bool) -> list[int]:
    """Numbers under which a word is indexed (``own``) or asks for others.

    A number stands for a gram, its place in and the length of the indexed word,
    the length of the other, and one half. ``lengths`` says how the indexed word
    may differ from this one, in length and in the place of the gram.
    """
    found = []
    for longer, later in lengths:
        indexed, other = (len(word), len(word) + longer) if own else (len(word) + longer, len(word))
        for half, text in enumerate(halves(word, len(word) + longer)):
            for gram, place in grams:
                where = f"{gram} {place + later} {indexed} {other} {half} ".encode()
                found.append(xxhash.xxh3_64_intdigest(where + text) - (1 << 63))
    return found


def _indexed(words: DataFrame) -> DataFrame:
    """words with the numbers under which each is indexed, and those under which it asks."""
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    distinct = F.array_distinct(F.transform(places, lambda i: F.substr("word", i, F.lit(GRAM))))
    # At most as many rows as there are pairs of letters.
    frequency = words.select(F.explode(distinct).alias("gram")).groupBy("gram").count().collect()
    ordered = sorted((r["count"], r["gram"]) for r in frequency)
    ranks = {gram: (rank, n) for rank, (n, gram) in enumerate(ordered)}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, asked = [], []
            for word in batch.column(0).to_pylist():
                all_grams = ((*ranks[word[i : i + GRAM]], i) for i in range(len(word) - GRAM + 1))
                rarest = heapq.nsmallest(PREFIX_GRAMS, ((rank, place, n) for rank, n, place in all_grams))
                rarest.sort(key=lambda g: g[1])
                grams = [(rank, place) for rank, place, _ in rarest]
                chosen = [grams[i] for i in pivots(grams, [n for _, _, n in rarest])]
                kept.append(_meetings(word, [(0, 0), (1, 0), (-1, 0)], grams, True))
                asked.append(_meetings(word, SHIFTS, chosen, False))
            numbers = [pa.array(column, pa.list_(pa.int64())) for column in (kept, asked)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *numbers], ["word", "n", "kept", "asked"])

    return words.mapInArrow(pick, "word string, n bigint, kept array<bigint>, asked array<bigint>")


def near_words(words: DataFrame) -> DataFrame:
    """a, b, n_a and n_b of all pairs of distinct words one edit apart, each once, a before b.

    ``words`` has word (distinct, at least ``PREFIX_GRAMS + 1`` characters) and n.
    Besides a pivot, words that meet share a half, which the edit leaves alone; so
    a gram that very many words have does not bring all of them together.
    """
    indexed = stage(_indexed(words), "word-grams", measure=[]).df
    ours = indexed.select("word", "n", F.explode("kept").alias("meeting"))
    asking = indexed.select(
        F.col("word").alias("other"), F.col("n").alias("n_other"), F.explode("asked").alias("meeting")
    )
    apart = F.levenshtein("word", "other", EDITS)
    first = F.col("word") < F.col("other")
    return (
        ours.join(asking, "meeting")
        .where((F.col("word") != F.col("other")) & (apart == EDITS))
        .select(
            F.least("word", "other").alias("a"),
            F.greatest("word", "other").alias("b"),
            F.when(first, F.col("n")).otherwise(F.col("n_other")).alias("n_a"),
            F.when(first, F.col("n_other")).otherwise(F.col("n")).alias("n_b"),
        )
        .distinct()
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word and root: the last word that following forms leads to.

    Forms get more frequent from step to step, so there are no circles, and
    chains are short. Every round doubles the steps that have been followed.
    """
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots").df
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(onward, "root", "left_semi").isEmpty():
            return roots
        roots = stage(
            roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "roots",
        ).df


def group_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word.

    A word's form is the most frequent word one edit away (ties: the smallest in
    code-point order) if that is at least ``ratio`` (more than 1) times as
    frequent, else NULL. ``root`` is the end of the chain of forms. ``words`` has
    word and n, each word once; no words give an empty result.
    """
    if ratio <= 1:
        raise ValueError("a form has to be more frequent than its word")
    words = stage(words.select("word", "n"), "words").df
    pairs = stage(near_words(words), "near-words").df
    facing = lambda word, other, n: F.struct(
        F.col(word).alias("word"), F.col(other).alias("other"), F.col(n).alias("n_other")
    )
    both = pairs.select(F.inline(F.array(facing("a", "b", "n_b"), facing("b", "a", "n_a"))))
    nearest = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("n_other")).alias("rank"), F.col("other"))).alias("best"),
    )
    frequent = -F.col("best.rank") >= ratio * F.col("n")
    found = stage(
        words.join(nearest, "word", "left").select(
            "word",
            F.when(frequent, F.col("best.other")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(frequent, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    ).df
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The variants among the words of whole texts; see ``count_words`` and ``group_variants``.

    NULL and empty texts have no words, NULL ids count as empty text, and every
    repeated row counts anew. Words of any length are compared.
    """
    return group_variants(count_words(docs, text, doc_id, **options))
