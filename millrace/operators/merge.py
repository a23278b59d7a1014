"""Keyed upsert and conditional merge as DataFrame rewrites.

Nothing here overwrites what it reads: each function returns the new content
of the target, to be written as a new snapshot (``millrace.sinks``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import dedup_latest
from millrace.workspace import BROADCAST_BYTES, Staged, measured_bytes, stage


class DuplicateSourceKeyError(ValueError):
    """More than one source row matches the same target row."""


def upsert_latest(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    buckets: int | None = None,
) -> DataFrame:
    """Target with the latest batch row of each key put in.

    A batch row replaces the stored row of its key; keys without a batch row
    keep theirs. With ``keep_later`` the stored row stays if its order value
    is larger, so a late old event does not undo a newer one; on equal order
    values the batch wins.

    The target must hold one row per key. The deduplicated batch is staged
    once and its keys are measured. If they fit ``broadcast_bytes`` the target
    is not shuffled at all; otherwise both sides are shuffled by key. Say in how
    many ``buckets`` by key the target is stored, and a large batch is sent to
    those buckets while the target stays where it is.
    """
    latest = stage_latest(batch, keys, order, ties)
    return upsert_staged(target, latest, keys, order, ties, keep_later, broadcast_bytes, buckets)


def stage_latest(
    batch: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str]
) -> Staged:
    """The latest row of each key in a batch, written once with its keys measured."""
    return stage(dedup_latest(batch, keys, order, ties), "upsert-batch", measure=keys)


def upsert_staged(
    target: DataFrame,
    latest: Staged,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    keep_later: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    buckets: int | None = None,
) -> DataFrame:
    """``upsert_latest`` for a batch that is staged already."""
    fits = latest.fits(broadcast_bytes)
    batch_keys = _side(latest.df.select(*keys), fits)
    stored = target.withColumn("_incoming", F.lit(0))
    incoming = latest.df.withColumn("_incoming", F.lit(1))
    later = [*order, "_incoming"]
    if not keep_later:
        changed = latest.df
    elif fits or buckets:
        matched = stored.join(batch_keys, list(keys), "left_semi")
        rivals = matched.unionByName(incoming)
        changed = dedup_latest(rivals, keys, later, ties).drop("_incoming")
    else:
        # Nearly every key may change: one shuffle of both is the least work.
        rivals = stored.unionByName(incoming)
        return dedup_latest(rivals, keys, later, ties).select(*target.columns)
    if buckets:
        changed = changed.repartition(buckets, *keys)
    untouched = target.join(batch_keys, list(keys), "left_anti")
    return untouched.unionByName(changed).select(*target.columns)


def _side(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _check_single_match(
    target: DataFrame, source: DataFrame, keys: Sequence[str], fits: bool
) -> None:
    """Raise if a source key occurs twice and is in the target.

    Only repeated source keys are looked up, so the target is not read in the
    usual case that there are none.
    """
    repeated = (
        source.where(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
        .select(*keys)
    )
    if repeated.isEmpty():
        return
    known = target.select(*keys)
    if fits:
        matched = known.join(F.broadcast(repeated), list(keys), "left_semi").first()
    else:
        matched = repeated.join(known.distinct(), list(keys), "left_semi").first()
    if matched is not None:
        raise DuplicateSourceKeyError(
            f"several source rows match target rows with key {matched.asDict()}"
        )


def _apply_updates(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], fits: bool
) -> DataFrame:
    """Target rows, with ``update`` columns taken from the matching source row."""
    changes = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in update], F.lit(True).alias("_matched")
    )
    joined = target.join(_side(changes, fits), list(keys), "left")
    changed = set(update)
    return joined.select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in target.columns
        ]
    )


def merge_update_insert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    stored: bool = False,
) -> DataFrame:
    """MERGE with WHEN MATCHED UPDATE and WHEN NOT MATCHED INSERT.

    Matched target rows take the ``update`` columns and keep the others.
    Source rows without a match are inserted whole. NULL keys match nothing,
    so such source rows are always inserted. ``on`` need not be unique in the
    target; two source rows for one target row raise
    ``DuplicateSourceKeyError``.

    The keys and update columns of the source are measured. If they fit
    ``broadcast_bytes`` the target is not shuffled. Otherwise updates are a
    left join of the target and inserts a left anti join of the source with
    the distinct target keys. Adaptive execution splits the left side of both,
    so any number of keys, NULL among them, may hold any share of the rows.

    The source is staged first, unless ``stored`` says that it is a stored
    table, which is cheap to read again. The target is read more than once, so
    give a stored table.
    """
    if set(source.columns) != set(target.columns):
        raise ValueError("source and target need the same columns")
    update = [c for c in update if c not in on]
    needed = [*on, *update]
    if stored:
        fits = measured_bytes(source, needed) <= broadcast_bytes
    else:
        staged = stage(source, "merge-source", measure=needed)
        source, fits = staged.df, staged.fits(broadcast_bytes)
    _check_single_match(target, source, on, fits)
    updated = _apply_updates(target, source.where(~_any_null(on)), on, update, fits)
    known = target.select(*on)
    if fits:
        # Distinct hits are some of the source keys, so the same bound holds.
        hits = known.join(F.broadcast(source.select(*on)), list(on), "left_semi")
        known = F.broadcast(hits.distinct())
    else:
        known = known.distinct()
    inserted = source.join(known, list(on), "left_anti")
    return updated.unionByName(inserted)


def merge_into(
    source: DataFrame, table: str, on: Sequence[str], update: Sequence[str]
) -> None:
    """The same MERGE, run by a table whose format supports row-level changes.

    Use this for such tables; ``merge_update_insert`` is for plain files.
    """
    condition = reduce(
        lambda a, b: a & b, [F.col(f"{table}.{k}") == F.col(f"source.{k}") for k in on]
    )
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .update({c: F.col(f"source.{c}") for c in update})
        .whenNotMatched()
        .insertAll()
        .merge()
    )
