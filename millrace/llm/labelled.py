"""Labelled samples of bounded size, and models fitted to them in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import as_bytes, quoted_col


def remainder(doc_id: Column, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo a number; NULL ids count as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learnable: Callable[[Column], Column],
    most: int,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """text and label of at most ``most`` labelled rows, chosen by a hash of the id.

    Rows without an id or a label, and rows that ``learnable`` refuses, are
    never chosen. The chosen ids are broadcast, as ``most`` bounds their number.
    Of several rows with one id the smallest text counts, so repeated rows do not
    add to the sample; an id with two labels is two rows of it.
    """
    chosen = (
        labels.select(quoted_col(doc_id).alias("id"), quoted_col(label).alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & learnable(F.col("id")))
        .distinct()
        .orderBy(F.md5(F.col("id").cast("string")), "id", "label")
        .limit(most)
    )
    texts = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    # Each task keeps one text of an id, however often it is repeated.
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    return found.select("id", "text", F.col("label").cast("int").alias("label"))


def fit_in_one_task(
    sample: DataFrame,
    features: Callable[[bytes | None], bytes],
    fit: Callable[[list[bytes], np.ndarray], bytes],
) -> bytes | None:
    """The model of a bounded sample; None for an empty one.

    The features are computed where the texts are and packed, and only they
    meet in the task that fits the model. They are ordered by id, so that
    reruns give the same model.
    """

    def described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [features(t) for t in as_bytes(part.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.string()), pa.array(found, pa.binary()), part.column(2)],
                    ["id", "features", "label"],
                )

    def fitted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if rows:
            rows.sort()
            model = fit([row[1] for row in rows], np.array([row[2] for row in rows], float))
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    described_rows = sample.mapInArrow(described, "id string, features binary, label int")
    models = described_rows.repartition(1).mapInArrow(fitted, "model binary").collect()
    return bytes(models[0]["model"]) if models else None


def scored(
    docs: DataFrame,
    score: Callable[[list[bytes | None]], np.ndarray],
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per input row: id and score."""
    rows = docs.select(quoted_col(doc_id).alias("id"), quoted_col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = score(as_bytes(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["id", "score"])

    return rows.mapInArrow(run, f"id {kind}, score double")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
