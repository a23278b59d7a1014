"""The registered queries of the operators, and the SQL that yields the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    exact_dedup,
    licenses,
    mixing,
    near_dedup,
    neural_lm,
    quality_model,
    quality_rules,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
    vector_codes,
)
from millrace.llm.labelled import remainder
from millrace.llm.text import small_batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

ENCODING_RANKS = "byte_bpe_multi_50k.tiktoken"
COUNTING_TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
# A score from here on is a prediction of label 1.
THRESHOLD = 0.3


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _predicted(scores: DataFrame) -> DataFrame:
    return scores.select(
        F.col("id").alias("doc_id"),
        "held_out",
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the passages it shares with others, and its class."""
    marked = substring_dedup.mark_repeats(documents(spark, sf_dir))
    return marked.withColumnRenamed("id", "doc_id")


@query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = documents(spark, sf_dir)
    return _predicted(quality_model.score(docs, quality_model.train(docs, labels(spark, sf_dir))))


MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS digest,
    CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sums AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS weight, [20, 0, -50][place % 3 + 1] AS tilt
  FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS place FROM sums)
), levels AS (
  SELECT *, (CAST(SUM(source_size) OVER () AS DOUBLE)
    - 3 * CAST(COALESCE(SUM(source_size) OVER (ORDER BY source_size / weight, place
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(SUM(weight) OVER (ORDER BY source_size / weight, place
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, weight * (100 + tilt) / 100.0 AS start,
    weight * (100 - tilt) / 100.0 AS finish,
    LEAST(CAST(3 * source_size AS DOUBLE), weight * (
      SELECT level FROM levels WHERE 3 * source_size >= level * weight
      ORDER BY source_size / weight, place LIMIT 1)) AS target
  FROM levels
), placed AS (
  SELECT s.*, t.source_size, t.target, t.start, t.finish, CAST(floor(t.target) AS BIGINT) AS wanted,
    CAST(COALESCE(SUM(size) OVER (PARTITION BY s.source ORDER BY digest, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, GREATEST(0, LEAST(size, wanted - rounds * source_size - before)) AS part
  FROM (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS rounds FROM placed)
)
SELECT doc_id, size, source_size, target, CAST(rounds * size + part AS BIGINT) AS taken,
  CAST(rounds + CASE WHEN 2 * part > size THEN 1 ELSE 0 END AS BIGINT) AS copies,
  CASE WHEN rounds * size + part > 0 THEN
    (before / target) * (start + finish)
      / (start + sqrt(start * start + (finish - start) * ((before / target) * (start + finish))))
  END AS position
FROM taken
"""


@query(MIXING_SQL)
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it, in training order."""
    mixed = mixing.mix(documents(spark, sf_dir), carry=["doc_id"])
    return mixed.select(
        "doc.doc_id", "size", "source_size", "target", "taken", "copies", "position"
    ).orderBy("position", "doc_id")


EXACT_DEDUP_SQL = r"""
SELECT doc_id, MIN(doc_id) OVER same AS keep_id, COUNT(*) OVER same AS group_size,
  doc_id = MIN(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (
  SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents
)
WINDOW same AS (PARTITION BY body)
"""


@query(EXACT_DEDUP_SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its equal texts."""
    marked = exact_dedup.mark_duplicates(documents(spark, sf_dir), carry=["doc_id"])
    return marked.select("doc.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count, and digests of its ids and of their decoding."""
    ranks = bpe.read_ranks(public_tokenizers.path(ENCODING_RANKS))
    encoded = bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUALITY_RULES_SQL = r"""
WITH split AS (
  SELECT doc_id, COALESCE(text, '') AS text,
    regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), lines AS (
  SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY doc_id
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split
), windows AS (
  SELECT doc_id, place, word || ' ' || LEAD(word, 1) OVER next || ' ' || LEAD(word, 2) OVER next AS words
  FROM placed
  WINDOW next AS (PARTITION BY doc_id ORDER BY place)
), again AS (
  SELECT doc_id, place FROM windows WHERE words IS NOT NULL
  QUALIFY COUNT(*) OVER (PARTITION BY doc_id, words) > 1
), covered AS (
  SELECT doc_id, COUNT(DISTINCT place + step) AS n_repeat_words
  FROM again, (SELECT unnest([0, 1, 2]) AS step)
  GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(COALESCE(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(COALESCE(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    COALESCE(n_lines, 0) AS n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks
  FROM split LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *,
    CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 10 * n_capitals > 3 * word_chars THEN 8 ELSE 0 END
    + CASE WHEN 4 * n_marks > n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 32 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 64 ELSE 0 END AS failed
  FROM measured
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed & 3 <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM judged
"""


@query(QUALITY_RULES_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ledger entry, and the verdicts of the base and the full policy."""
    return quality_rules.ledger(documents(spark, sf_dir)).select(
        "doc.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.rejected("v1").alias("base_failed"),
        (~quality_rules.rejected("v2")).alias("kept"),
        "failed",
    )


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    docs = documents(spark, sf_dir)
    return _predicted(toxicity.score(docs, toxicity.train(docs, labels(spark, sf_dir))))


NEAR_DEDUP_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(words[place:place + 4], ' ')) AS shingle
  FROM (
    SELECT doc_id, words, unnest(generate_series(1, GREATEST(len(words) - 4, 1))) AS place
    FROM split WHERE len(words) > 0
  )
), sizes AS (
  SELECT doc_id, COUNT(*) AS n_shingles FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM common
  JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n >= 75 * (x.n_shingles + y.n_shingles - n)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), components AS (
  SELECT doc_id, MIN(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, COALESCE(n_shingles, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""


@query(NEAR_DEDUP_SQL)
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id among its near-duplicates."""
    found = near_dedup.near_duplicates(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


@query()
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of a license template in a document."""
    return licenses.scan(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens."""
    tokenizer = token_counts.read_tokenizer(public_tokenizers.path(COUNTING_TOKENIZER))
    counted = token_counts.count_tokens(documents(spark, sf_dir), tokenizer)
    return counted.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


SQL_DISTANCE = " + ".join(f"(part[{i}] - centre[{i}]) * (part[{i}] - centre[{i}])" for i in range(1, 5))
SQL_MEAN = ", ".join(f"CAST(floor(CAST(SUM(part[{i}]) AS DOUBLE) / COUNT(*)) AS BIGINT)" for i in range(1, 5))


def _lloyd_round_sql(number: int) -> str:
    """Assign parts to the codebook of the round before and move its entries."""
    return f"""assigned{number} AS (
  SELECT vec_id, position, ANY_VALUE(part) AS part, MIN([{SQL_DISTANCE}, entry]) AS best
  FROM parts JOIN book{number} USING (position) GROUP BY vec_id, position
), book{number + 1} AS (
  SELECT b.position, b.entry, COALESCE(m.centre, b.centre) AS centre
  FROM book{number} b LEFT JOIN (
    SELECT position, best[2] AS entry, [{SQL_MEAN}] AS centre
    FROM assigned{number} GROUP BY ALL
  ) m ON m.position = b.position AND m.entry = b.entry
)"""


VECTOR_CODES_SQL = f"""
WITH kept AS (
  SELECT vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS numbers
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, position, numbers[4 * position + 1 : 4 * position + 4] AS part
  FROM kept, range(16) AS p(position)
), book0 AS (
  SELECT position, entry, numbers[4 * position + 1 : 4 * position + 4] AS centre
  FROM (SELECT numbers, ROW_NUMBER() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
    ORDER BY vec_id LIMIT 64), range(16) AS p(position)
), {_lloyd_round_sql(0)}, {_lloyd_round_sql(1)}, {_lloyd_round_sql(2)}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', best[2]), '' ORDER BY position) AS code,
    CAST(SUM(best[1]) AS BIGINT) AS error
  FROM assigned2 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(array_to_string(centre, ','), ',' ORDER BY position, entry)) AS digest FROM book2
)
SELECT c.vec_id, code, error,
  CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded c JOIN kept k ON k.vec_id = c.vec_id, books
"""


@query(VECTOR_CODES_SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kept vector's product code, with errors and a digest of the codebooks."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes, books = vector_codes.compress(vectors)
    return codes.select(
        F.col("id").alias("vec_id"),
        "code",
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the form it is a variant of, after one typo in 199 runs."""
    return spelling.spelling_variants(documents(spark, sf_dir), garble=spelling.one_typo_in(199))


@query()
def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the model and by word counts alone."""
    docs = documents(spark, sf_dir)
    model = neural_lm.train(docs, learnable=lambda doc_id: remainder(doc_id, 10) != 0)
    return neural_lm.score(docs, model).select(
        F.col("id").alias("doc_id"),
        (remainder(F.col("id"), 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.vocabulary.total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
