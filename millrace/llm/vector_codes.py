"""Product codes of vectors: codebooks by Lloyd rounds whose members stay with their owners.

A vector of integers is cut into equal parts, and the parts of each position have
a codebook of their own. While codebooks are fitted, every part is a member of
the owner of its position and nearest entry. An owner is split by a salt, so that
an entry which very many parts share has many owners. Members are placed once. In
each round owners sum their members where they lie, and members whose nearest
entry is a new one move on: only these are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import quoted_col
from millrace.session import sized_for
from millrace.workspace import BROADCAST_BYTES, fresh_path, stage

POSITIONS = 16
ENTRIES = 64
ROUNDS = 2

# A component x becomes floor(SCALE * x). Beyond the limit it is taken for the
# limit, so that sums of squares stay within 64 bits.
SCALE = 256
LIMIT = 1 << 26

# Members that one owner of a position, entry and salt has on average at most.
MOST_OWNED = 1024

# Rows whose distances to all entries are held at a time.
CHUNK = 4096

_MEMBERS = "row bigint, position int, entry int, salt bigint, part array<int>"


@dataclass(frozen=True)
class Codebooks:
    """Integer entries by position, entry and place within the part."""

    entries: np.ndarray

    @property
    def positions(self) -> int:
        return self.entries.shape[0]

    @property
    def dimension(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        """Digest of all components as decimal numbers, in order, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each part; ties to the lower index."""
    index, best = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    for at in range(0, len(parts), CHUNK):
        chunk = parts[at : at + CHUNK].astype(np.int64)
        distance = np.zeros((len(chunk), len(entries)), np.int64)
        for place in range(parts.shape[1]):
            apart = chunk[:, place, None] - entries[None, :, place]
            distance += apart * apart
        found = distance.argmin(axis=1)
        index[at : at + CHUNK] = found
        best[at : at + CHUNK] = distance[np.arange(len(chunk)), found]
    return index, best


def _whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _integers(vector: Column) -> Column:
    """Components as scaled integers."""
    scaled = lambda x: F.floor(F.least(F.greatest(SCALE * x, F.lit(-float(LIMIT))), F.lit(float(LIMIT))))
    return F.transform(vector, lambda x: scaled(x).cast("int"))


def _kept(vectors: DataFrame, vector: str, vec_id: str, label: str, positions: int) -> DataFrame:
    numbers = quoted_col(vector).cast("array<double>")
    return vectors.select(
        quoted_col(vec_id).alias("id"),
        quoted_col(label).alias("label"),
        F.when(_whole(numbers), _integers(numbers)).alias("numbers"),
    ).where((F.size("numbers") > 0) & (F.size("numbers") % positions == 0))


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column of lists of one length as rows of a matrix."""
    values = batch.column(batch.schema.get_field_index(name)).flatten()
    return values.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _lists(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, max(rows.shape[1], 1), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel().astype(np.int32)))


def _placed(vectors: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """Every part of every vector with its nearest entry and its salt."""
    positions, _, width = books.shape

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            numbers = _flat(batch, "numbers").reshape(len(rows), positions, width)
            for position in range(positions):
                parts = numbers[:, position]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        pa.array(np.full(len(rows), position, np.int32)),
                        pa.array(nearest(parts, books[position])[0].astype(np.int32)),
                        pa.array(rows % salts),
                        _lists(parts),
                    ],
                    ["row", "position", "entry", "salt", "part"],
                )

    return vectors.select("row", "numbers").mapInArrow(split, _MEMBERS)


def _reassigned(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with the entry that is nearest now, and whether it is a new one."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            position, former = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            parts, entry = _flat(batch, "part"), np.empty(batch.num_rows, np.int32)
            for own in np.unique(position):
                here = position == own
                entry[here] = nearest(parts[here], books[own])[0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(entry), *batch.columns[3:], pa.array(entry != former)],
                ["row", "position", "entry", "salt", "part", "moved"],
            )

    return members.mapInArrow(assign, _MEMBERS + ", moved boolean")


def _updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Entries moved to the floor of their members' mean; those without members stay.

    Every task adds up the members that it holds, so an entry arrives as one row
    per task and component. The driver gets one number for each of a codebook.
    """
    width = books.shape[2]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            place = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            np.add.at(count, place, 1)
            np.add.at(total, place, _flat(batch, "part").astype(np.int64))
        position, entry = np.nonzero(count)
        each = np.repeat(np.arange(len(position)), width)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(position[each].astype(np.int32)),
                pa.array(entry[each].astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(position))),
                pa.array(count[position, entry][each]),
                pa.array(total[position, entry].ravel()),
            ],
            ["position", "entry", "place", "count", "total"],
        )

    sums = (
        members.select("position", "entry", "part")
        .mapInArrow(add_up, "position int, entry int, place int, count bigint, total bigint")
        .groupBy("position", "entry", "place")
        # A sum can exceed 64 bits where its mean does not.
        .agg(F.sum("count").alias("count"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    )
    moved = books.copy()
    for row in sums.collect():
        moved[row["position"], row["entry"], row["place"]] = int(row["total"]) // row["count"]
    return moved


def fit(vectors: DataFrame, rows: int, positions: int, entries: int, rounds: int, dimension: int) -> Codebooks:
    """Codebooks of staged vectors (row, id, numbers) after some Lloyd rounds."""
    spark = vectors.sparkSession
    smallest = vectors.orderBy(F.col("id").asc_nulls_last(), "numbers").select("numbers").limit(entries)
    seeds = np.array([r["numbers"] for r in smallest.collect()], np.int64)
    books = seeds.reshape(len(seeds), positions, dimension // positions).transpose(1, 0, 2).copy()
    members = None
    for number in range(rounds):
        if members is None:
            placed = _placed(vectors, books, max(-(-rows // MOST_OWNED), 1))
            members = stage(placed.repartition("position", "entry", "salt"), "members", measure=[]).df
        else:
            path = fresh_path(spark, f"assigned-{number}")
            _reassigned(members, books).write.partitionBy("moved").parquet(path)
            assigned = spark.read.schema(_MEMBERS + ", moved boolean").parquet(path)
            movers = assigned.where("moved").drop("moved").repartition("position", "entry", "salt")
            arrived = stage(movers, "movers", measure=[]).df
            members = assigned.where("NOT moved").drop("moved").unionByName(arrived)
        books = _updated(members, books)
    return Codebooks(books)


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``vectors`` (id, label, numbers) as id, label, code and error, without a shuffle.

    The code has two hexadecimal digits for each part, the index of the nearest
    entry; the error is the squared distance, summed over the parts.
    """
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    width = books.dimension // max(books.positions, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = _flat(batch, "numbers").reshape(batch.num_rows, books.positions, width)
            codes, error = np.empty(numbers.shape[:2], np.uint8), np.zeros(len(numbers), np.int64)
            for position in range(books.positions):
                found, distance = nearest(numbers[:, position], books.entries[position])
                codes[:, position] = found
                error += distance
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([code.tobytes().hex() for code in codes]), pa.array(error)],
                ["id", "label", "code", "error"],
            )

    return vectors.select("id", "label", "numbers").mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"
    )


def compress(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    label: str = "label",
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks that they refer to.

    The frame has one row per kept row: id, label, code, error and label_error,
    the sum of the errors of equal labels (NULLs together; NULL if it exceeds 64
    bits). Rows are left out whose vector is NULL or empty, holds a NULL or a
    component that is not finite, cannot be cut into ``positions`` equal parts,
    or is not as long as that of the smallest id. Codebooks start as the parts of
    the rows with the smallest ids, NULL ids last and equal ones in the order of
    their vectors; fewer rows than ``entries`` make smaller codebooks, no rows an
    empty result. Repeated ids are rows of their own.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index takes two hexadecimal digits: 1 to 256 entries")
    numbered = _kept(vectors, vector, vec_id, label, positions).withColumn(
        "row", F.monotonically_increasing_id()
    )
    # Staged, so that a row keeps its number even if a task is run again.
    staged = stage(numbered, "vectors", measure=[])
    rows, dimension = staged.df, 0
    first = rows.orderBy(F.col("id").asc_nulls_last(), "numbers").select(F.size("numbers")).first()
    if first is not None:
        dimension = first[0]
        rows = rows.where(F.size("numbers") == dimension)
    with sized_for(vectors.sparkSession, staged.path):
        books = (
            fit(rows, staged.rows, positions, entries, rounds, dimension)
            if dimension
            else Codebooks(np.empty((positions, 0, 0), np.int64))
        )
        coded = stage(encode(rows, books), "codes", measure=[]).df
        sums = stage(
            coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "label-errors"
        )
    side = F.broadcast(sums.df) if sums.fits(BROADCAST_BYTES) else sums.df
    side = side.withColumnRenamed("label", "same_label")
    joined = coded.join(side, F.col("label").eqNullSafe(F.col("same_label")), "left")
    return joined.select("id", "label", "code", "error", "label_error"), books
