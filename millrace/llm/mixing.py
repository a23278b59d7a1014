"""Mixing sources to target weights along a time-varying curriculum.

Training runs from time 0 to 1. A source's share of the stream is a linear
function of time, given by its weight at both ends. Integrated, it says how
many words of the source the stream has used at any time; inverted, it gives
each document the time at which its words are due. Sorting by that time yields
the stream. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import WORD, quoted_col, whole_row

# No document is used more often than this.
MOST_EPOCHS = 3
WEIGHTS = (5, 2, 1)
# How far a weight moves from its mean towards either end of training, in
# percent, by the source's place among the sources.
TILTS = (20, 0, -50)
# A source's documents are taken in the order of a hash of their id. It is cut
# into 16 ** this many equal ranges, each summed by a task of its own.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """The source as a value that is never NULL, so that plain joins find it."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, tilts: tuple[int, ...] = TILTS
) -> DataFrame:
    """Target of each source: source, source_size, target, start, finish.

    ``sizes`` holds source and source_size, one row per source. Sources in the
    order of their code points, NULL last, take the weights in turn and share
    the sum of all sizes by weight. A target stops at ``MOST_EPOCHS`` times the
    source's size, and what is over goes to the others by weight until no
    target is above. That is the one level at which targets add up to the sum:
    in order of size by weight, the sources that reach their stop come first.
    ``start`` and ``finish`` are the weights at both ends of training.

    The running sums have one row per source, and so one task; a table has
    as many sources as it has sites or collections, not as it has documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    place = (F.row_number().over(by_name) - 1).alias("place")
    turn = lambda values: F.element_at(
        F.array(*[F.lit(v) for v in values]), (F.col("place") % len(values) + 1).cast("int")
    )
    weighed = (
        sizes.select("source", "source_size", place)
        .withColumn("weight", turn(weights).cast("long"))
        .withColumn("tilt", turn(tilts).cast("long"))
    )
    # Stops in the order in which a rising level reaches them.
    by_stop = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    after = by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything).cast("double")
        - MOST_EPOCHS * F.coalesce(F.sum("source_size").over(before), F.lit(0)).cast("double")
    ) / F.sum("weight").over(after).cast("double")
    stop = (MOST_EPOCHS * F.col("source_size")).cast("double")
    levels = weighed.withColumn("level", level).withColumn(
        "own", F.when(stop >= F.col("level") * F.col("weight"), F.col("level"))
    )
    # The level of the first source that does not reach its stop holds for all.
    order = F.struct(F.col("source_size") / F.col("weight"), F.col("place"))
    common = F.min_by("own", F.when(F.col("own").isNotNull(), order)).over(everything)
    target = F.least(stop, common * F.col("weight"))
    return levels.select(
        "source",
        "source_size",
        target.alias("target"),
        (F.col("weight") * (100 + F.col("tilt")) / 100.0).alias("start"),
        (F.col("weight") * (100 - F.col("tilt")) / 100.0).alias("finish"),
    )


def due(fraction: Column, start: Column, finish: Column) -> Column:
    """Time by which a source has given a fraction of its words.

    The integral of the weight up to time t, over the whole integral, is
    (start t + (finish - start) t² / 2) / ((start + finish) / 2). This is its
    inverse, in the form that holds for a constant weight too.
    """
    slope = finish - start
    used = fraction * (start + finish)
    return used / (start + F.sqrt(start * start + slope * used))


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per input row: doc, size, source_size, target, taken, copies, position.

    ``taken`` is how many words of the row the stream uses, repeats counted. A
    source gives whole rounds over all its rows as long as its target lasts,
    and one more round over its first rows in the order of a hash of the id,
    the last of these in part; so the taken words of a source are its target,
    rounded down. ``copies`` rounds the partly used row to whole copies.
    ``position`` is when the row's first words are due, NULL if none is used.

    Rows without text have size 0 and are never taken; NULL is a source like
    any other, and so is NULL as an id. Rows that repeat an id are ordered by
    a hash of their text; equal rows are interchangeable. Each row is counted.

    A source may hold most of the rows: sums are combined in each task, and
    running sums are taken within ranges of the hash, not over whole sources.
    """
    carried = docs.select(*map(quoted_col, docs.columns if carry is None else carry))
    digest = F.md5(F.coalesce(quoted_col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(
        whole_row(carried),
        quoted_col(doc_id).alias("id"),
        quoted_col(source).cast("string").alias("source"),
        source_key(quoted_col(source).cast("string")).alias("key"),
        word_count(quoted_col(text)).alias("size"),
        digest.alias("digest"),
        F.substring(digest, 1, RANGE_DIGITS).alias("range"),
        F.xxhash64(quoted_col(text)).alias("tie"),
    )
    ranges = rows.groupBy("key", "source", "range").agg(F.sum("size").alias("range_size"))
    sizes = ranges.groupBy("key", "source").agg(F.sum("range_size").alias("source_size"))
    targets = source_targets(sizes).withColumn("key", source_key(F.col("source")))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset")
    known = ranges.select("key", "range", offset).join(targets.drop("source"), "key")
    within = (
        Window.partitionBy("key", "range")
        .orderBy("digest", "id", "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("size").over(within), F.lit(0))
    placed = rows.drop("source").withColumn("before", before).join(known, ["key", "range"])
    at = F.col("offset") + F.col("before")
    wanted = F.floor("target")
    rounds = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(0)
    rest = wanted - F.col("rounds") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("at")))
    taken = F.col("rounds") * F.col("size") + F.col("part")
    first = due(F.col("at") / F.col("target"), F.col("start"), F.col("finish"))
    return (
        placed.withColumn("at", at.cast("long"))
        .withColumn("rounds", rounds.cast("long"))
        .withColumn("part", part.cast("long"))
        .withColumn("taken", taken.cast("long"))
        .select(
            "doc",
            "size",
            "source_size",
            "target",
            "taken",
            (F.col("rounds") + F.when(2 * F.col("part") > F.col("size"), 1).otherwise(0))
            .cast("long")
            .alias("copies"),
            F.when(F.col("taken") > 0, first).alias("position"),
            "at",
            "start",
            "finish",
        )
    )


def training_stream(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """The mixed documents in training order, each as often as it has copies.

    The rows keep the columns of ``docs``. A copy is due when its source has
    given the words before it; the rows are range-sorted by that time, so the
    files of a written stream follow one another. Times that tie are ordered
    by id. Sources whose words are all in rows without copies give nothing.
    """
    mixed = mix(docs, text, doc_id, source)
    copies = mixed.where("copies > 0").withColumn(
        "round", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))
    )
    offset = (F.col("at") + F.col("round") * F.col("source_size")) / F.col("target")
    time = due(F.least(offset, F.lit(1.0)), F.col("start"), F.col("finish"))
    return (
        copies.withColumn("time", time)
        .withColumn("id", F.col("doc")[doc_id])
        .orderBy("time", "id", "round")
        .select("doc.*")
    )
