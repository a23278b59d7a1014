"""Awkward rows that every operator must take, and small helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, id string, doc string, key int, label int"

LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 3000


def prose(seed: int, words: int) -> str:
    picker = random.Random(seed)
    parts = ["ba", "co", "di", "fu", "ge", "la", "mo", "ni", "pa", "ru", "se", "ti"]
    made = ["".join(picker.choices(parts, k=picker.randint(1, 4))) for _ in range(words)]
    return " ".join(made)


def awkward_rows() -> list[tuple]:
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    extra = ("x", "y", 1, 2)
    common = prose(1, 80)
    return [
        (1, common, "en", "a", *extra),
        (2, common, "en", "b", *extra),
        (2, common, "en", "b", *extra),
        (2, prose(2, 60), "en", "b", *extra),
        (None, common, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (3, None, "fr", "a", *extra),
        (4, "", "fr", "a", *extra),
        (5, " \t\n\x0b\x0c\r ", "fr", None, *extra),
        (6, "one two", "fr", "a", *extra),
        (7, "One\tTwo", "fr", "a", *extra),
        (8, LONG, "de", "c", *extra),
        (9, "\xe9" * 5000 + "\u3000 x\x1cy \u2003 z\xa0", "de", "c", *extra),
        (-10, prose(3, 200), "de", "", *extra),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
