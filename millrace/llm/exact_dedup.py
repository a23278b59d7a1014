"""Exact duplicates: grouped by a 128-bit content hash, compared byte by byte.

Every function takes rows with an id and a text column under any names. NULL
text counts as empty. Texts are equal if the bytes of their normalised forms
are. An empty table gives an empty result; other columns are carried as one
struct, so their names cannot clash with those used here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import GAP, quoted_col, whole_row
from millrace.workspace import stage


def normalised(text: Column) -> Column:
    """Each run of blanks as one space; NULL as empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def _texts(docs: DataFrame, text: str, doc_id: str, *more: Column) -> DataFrame:
    return docs.select(
        quoted_col(doc_id).alias("id"), normalised(quoted_col(text)).alias("body"), *more
    ).withColumn("hash", F.md5("body"))


def equal_texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct text: hash, body, keep_id, group_size.

    Rows meet by the MD5 of their text and are then told apart by the text
    itself, so two texts that share a hash stay apart. Copies collapse in the
    task that reads them: a group with a third of all rows is shuffled as one
    row per task.
    """
    return (
        _texts(docs, text, doc_id)
        .groupBy("hash", "body")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def mark_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per input row: doc, keep_id, group_size, kept, text_sha256.

    ``doc`` holds the ``carry`` columns, by default all. The smallest id of a
    group stays. A row without an id is dropped if another row of its group
    has one; if none has, ``keep_id`` is NULL and all rows of the group are
    kept, as are rows that repeat both id and text. ``drop_duplicates`` keeps
    exactly one row in these cases too.

    A row finds its class by the hash alone. Only if some hash stands for
    several texts are the rows under it joined by the text itself.
    """
    carried = docs.select(*map(quoted_col, docs.columns if carry is None else carry))
    classes = equal_texts(docs, text, doc_id)
    found = stage(classes.drop("body"), "equal-texts").df
    shared = found.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    rows = _texts(docs, text, doc_id, whole_row(carried))
    answer = ["doc", "id", "text_sha256", "keep_id", "group_size"]
    if shared.isEmpty():
        marked = _with_digest(rows).join(found, "hash").select(answer)
    else:
        several = stage(shared.select("hash"), "shared-hashes").df
        alone = found.join(several, "hash", "left_anti")
        apart = classes.join(several, "hash", "left_semi")
        marked = (
            _with_digest(rows)
            .join(alone, "hash")
            .select(answer)
            .unionByName(
                rows.withColumn("text_sha256", F.sha2("body", 256))
                .join(apart, ["hash", "body"])
                .select(answer)
            )
        )
    kept = F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull())
    return marked.select("doc", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def _with_digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc", "id", "hash", F.sha2("body", 256).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, exactly one per distinct text, with all their columns.

    The smallest id stays; rows without an id only if no other has the text.
    Between rows with one id the smaller hash of the original text decides.
    """
    order = F.struct(
        quoted_col(doc_id).isNull(), quoted_col(doc_id), F.xxhash64(quoted_col(text))
    )
    return (
        _texts(docs, text, doc_id, whole_row(docs), order.alias("order"))
        .groupBy("hash", "body")
        .agg(F.min_by("doc", "order").alias("doc"))
        .select("doc.*")
    )
