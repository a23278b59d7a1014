"""Quality rules as a ledger of failure bits, judged later by versioned policies.

The ledger evaluates every rule once per document and stores the measured
values and one bit per failed rule. A policy is a set of rules; its verdict is
one bitwise AND over the ledger. New policies and ablations never read the
texts again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from millrace.llm.text import as_bytes, quoted_col, whole_row

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_capitals",
    "n_marks",
)
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_window_words(words: Sequence[bytes], width: int = 3) -> int:
    """Words inside runs of ``width`` words that occur at least twice in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    row = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    key = row[:n]
    for place in range(1, width):
        # Renumbered after each word, so that no product can overflow.
        key = np.unique(key * len(ids) + row[place : n + place], return_inverse=True)[1]
    again = np.flatnonzero(np.bincount(key)[key] > 1)
    covered = np.zeros(len(words), bool)
    for place in range(width):
        covered[again + place] = True
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The values of ``MEASURES`` for one text; all 0 for NULL."""
    text = text or b""
    words = text.split()
    body = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(body) - _occurrences(body, _CONTINUATION),
        _occurrences(body, _SYMBOLS),
        len(lines) - len(Counter(lines)),
        repeated_window_words(words),
        len(lines),
        _occurrences(body, _CAPITALS),
        body.count(b"!"),
    )


def _occurrences(body: bytes, of: bytes) -> int:
    return len(body) - len(body.translate(None, of))


@arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measured(texts: pa.Array) -> pa.Array:
    values = np.array([measure(t) for t in as_bytes(texts)], np.int64).reshape(-1, len(MEASURES))
    return pa.StructArray.from_arrays([pa.array(c) for c in values.T], list(MEASURES))


@dataclass(frozen=True)
class Rule:
    """A document fails if the SQL condition over the measures is true."""

    name: str
    fails: str


# A rule's place is its bit. Never reorder: stored ledgers refer to the places.
RULES = (
    Rule("too_short", "n_words < 50"),
    Rule("repeats_itself", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("shouting", "10 * n_capitals > 3 * word_chars"),
    Rule("exclaims", "4 * n_marks > n_words"),
    Rule("repeats_lines", "2 * n_dup_lines > n_lines"),
    Rule("odd_word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)

# Versions of the policy: the rules that reject a document.
BASE = ("too_short", "repeats_itself")
POLICIES = {
    "v1": BASE,
    "v2": tuple(rule.name for rule in RULES),
}


def mask_of(rules: Sequence[str]) -> int:
    places = {rule.name: place for place, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in rules)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc`` (the whole row), the measures and ``failed``, the bits of failed rules.

    NULL and empty texts have no words: they fail ``too_short`` and have 0 in
    every measure. Rows are independent, so repeated rows, ids and other
    columns do not matter, and nothing is shuffled.
    """
    found = docs.select(whole_row(docs), measured(quoted_col(text)).alias("found"))
    flat = found.select("doc", "found.*")
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long")
        for place, rule in enumerate(RULES)
    ]
    return flat.withColumn("failed", sum(bits[1:], bits[0]))


def rejected(policy: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) != 0


def passing(docs: DataFrame, policy: str = "v2", text: str = "text") -> DataFrame:
    """The input rows that a policy does not reject."""
    return ledger(docs, text).where(~rejected(policy)).select("doc.*")


def ablation(entries: DataFrame, policy: str = "v2") -> DataFrame:
    """For each rule of a policy: documents that fail it, and that fail nothing else.

    ``only`` is what dropping the rule would bring back. ``union_bits`` and
    ``common_bits`` are the OR and AND of the failures of the documents that
    fail the rule: rules that ever, and that always, go with it. One aggregate
    over the ledger; the entries are combined in each task before they meet.
    """
    mask = F.lit(mask_of(POLICIES[policy])).cast("long")
    bits = F.col("failed").bitwiseAND(mask)
    places = [(place, r) for place, r in enumerate(RULES) if r.name in POLICIES[policy]]
    counts = []
    for place, rule in places:
        fails = bits.bitwiseAND(F.lit(1 << place).cast("long")) != 0
        counts += [
            F.count_if(fails).alias(f"failed_{rule.name}"),
            F.count_if(bits == F.lit(1 << place).cast("long")).alias(f"only_{rule.name}"),
            F.bit_or(F.when(fails, bits)).alias(f"union_{rule.name}"),
            F.bit_and(F.when(fails, bits)).alias(f"common_{rule.name}"),
        ]
    total = entries.agg(F.count(F.lit(1)).alias("documents"), *counts)
    row = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.col("documents"),
                    F.col(f"failed_{rule.name}").alias("failed"),
                    F.col(f"only_{rule.name}").alias("only"),
                    F.col(f"union_{rule.name}").alias("union_bits"),
                    F.col(f"common_{rule.name}").alias("common_bits"),
                )
                for _, rule in places
            ]
        )
    )
    return total.select(row.alias("row")).select("row.*")
