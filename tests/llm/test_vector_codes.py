"""Product codes against a plain version, and rows that are left out."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from millrace.llm import vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, row int, code string"


def plain(rows, positions=16, entries=64, rounds=2):
    """(vec_id, label, code, error) of each kept row, and the digest of the codebooks."""
    kept = []
    for vec_id, vector, label in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    width = len(kept[0][2]) // positions
    cut = [[r[2][p * width : (p + 1) * width] for p in range(positions)] for r in kept]
    books = [[parts[p] for parts in cut[:entries]] for p in range(positions)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(positions):
            members = {}
            for parts in cut:
                members.setdefault(assign(parts[p], books[p])[1], []).append(parts[p])
            for i, own in members.items():
                books[p][i] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    out = []
    for (vec_id, label, _), parts in zip(kept, cut, strict=True):
        best = [assign(part, books[p]) for p, part in enumerate(parts)]
        out.append((vec_id, label, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best)))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return out, digest


def made(seed, n, dimension=32):
    picker = np.random.default_rng(seed)
    return [
        (int(i), picker.normal(0, 0.2, dimension).astype(np.float32).tolist(), int(i) % 3 or None) for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def compare(spark, rows, **options):
    frame_, books = vector_codes.compress(frame(spark, rows), **options)
    want, digest = plain(rows, **options)
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    got = [tuple(r) for r in frame_.collect()]
    assert sorted(got, key=repr) == sorted(((*r, sums[r[1]]) for r in want), key=repr)
    assert books.sha256() == digest
    return got


def test_equals_a_plain_version(spark):
    compare(spark, made(1, 300))


def test_more_rounds_and_other_shapes(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MOST_OWNED", 7)
    compare(spark, made(2, 120, 12), positions=4, entries=9, rounds=4)


def test_a_vector_that_a_third_of_all_rows_share(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "MOST_OWNED", 16)
    rows = made(3, 200)
    rows += [(1000 + i, rows[5][1], None) for i in range(100)]
    compare(spark, rows, rounds=3)


def test_owners_of_a_hot_entry_are_many(spark):
    rows = made(4, 30)
    rows = [(i, rows[0][1], 0) for i in range(5000)]
    frame_ = frame(spark, rows)
    kept = vector_codes._kept(frame_, "embedding", "vec_id", "label", 16).selectExpr(
        "monotonically_increasing_id() AS row", "numbers"
    )
    seeds = np.zeros((16, 2, 2), np.int64)
    placed = vector_codes._placed(kept, seeds, -(-5000 // vector_codes.MOST_OWNED))
    owners = placed.groupBy("position", "entry", "salt").count().collect()
    assert max(r["count"] for r in owners) <= vector_codes.MOST_OWNED


def test_only_movers_are_shuffled(spark, plan_of):
    rows = [(i, [0.0] * 16 + [float(i % 2)] * 16, 0) for i in range(40)]
    members = vector_codes._placed(
        vector_codes._kept(frame(spark, rows), "embedding", "vec_id", "label", 16).selectExpr(
            "monotonically_increasing_id() AS row", "numbers"
        ),
        np.zeros((16, 1, 2), np.int64),
        1,
    )
    books = np.zeros((16, 2, 2), np.int64)
    books[:, 1] = 256
    again = vector_codes._reassigned(members, books)
    assert "Exchange" not in plan_of(again)
    moved = again.where("moved").collect()
    assert len(moved) == 20 * 8 and {(r["entry"], r["position"] >= 8) for r in moved} == {(1, True)}


def test_rows_without_a_whole_vector_are_left_out(spark):
    good = made(5, 40)
    bad = [
        (-1, None, 1),
        (-2, [], 1),
        (-3, [None] * 32, 1),
        (-4, [math.nan] * 32, 1),
        (-5, [math.inf] + [0.0] * 31, 1),
        (-6, [-math.inf] * 32, None),
        (-7, [1.0] * 31, 1),
    ]
    got = compare(spark, good + bad[:6])
    assert len(got) == 40
    frame_, _ = vector_codes.compress(frame(spark, good + bad))
    assert {r["id"] for r in frame_.collect()} == set(range(40))
    # A length that can be cut, but is not that of the smallest id.
    frame_, _ = vector_codes.compress(frame(spark, [*good, (99, [0.0] * 16, 1)]))
    assert {r["id"] for r in frame_.collect()} == set(range(40))


def test_ties_repeats_and_missing_ids(spark):
    rows = made(6, 10)
    rows += [(3, rows[3][1], 2), (3, rows[4][1], None), (None, rows[0][1], None), (None, rows[9][1], 1)]
    assert len(compare(spark, rows)) == 14


def test_large_components_are_limited(spark):
    rows = [(i, [3e38, -3e38] * 8, 1) for i in range(3)]
    frame_, books = vector_codes.compress(frame(spark, rows))
    assert [r["error"] for r in frame_.collect()] == [0, 0, 0]
    assert int(np.abs(books.entries).max()) == vector_codes.LIMIT


def test_no_rows(spark):
    frame_, books = vector_codes.compress(frame(spark, []))
    assert frame_.collect() == [] and frame_.columns == ["id", "label", "code", "error", "label_error"]
    assert books.sha256() == hashlib.sha256(b"").hexdigest()


def test_an_index_fits_two_digits(spark):
    with pytest.raises(ValueError, match="256"):
        vector_codes.compress(frame(spark, []), entries=257)
