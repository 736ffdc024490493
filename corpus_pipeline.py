"""Corpus pipeline: documents to token sequences, five stages in a row.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet to
the cluster's checkpoint folder and read again as the next stage's ``docs``.  All stages but the
last return the columns of ``documents``.

1. quality rules: failing lines go, then documents that the rules reject;
2. near duplicates: of each group of documents linked by five-word shingles at a Jaccard
   similarity of 0.8 or more, the one with the least id stays (without words: all stay);
3. repeated strings of 100 bytes or more are cut out where they start earlier elsewhere;
4. mixing: sources are mixed to their target weights; a document comes once per epoch in which
   the mix takes a part of it, cut to the words taken;
5. encoding: doc_id, source, token ids, their number, and whether decoding gives the text back.

A document without an id, a text or a source goes through like any other; an empty table gives
an empty result with the same columns.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_rules, mixing, ngram_join, pieces, suffix_dedup
from tessera.llm.common import cleared, documents, dropped, saved, ship_package, written, written_since

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


_OF_STAGES: set[str] = set()


def _stage(fn: Callable) -> Callable:
    """A stage begins when its predecessor's result is written: the tables that stages have saved on
    the way and ``docs`` does not read are deleted.  Arrow batches are kept small unless the session sets their size."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        if spark.conf.get(BATCH_BYTES, None) is None:
            spark.conf.set(BATCH_BYTES, "8m")
        cleared(spark, keep=docs, only=_OF_STAGES)
        mark = written()
        out = fn(spark, docs, sf_dir)
        _OF_STAGES.update(written_since(mark))
        return out
    return run_stage


def _as_documents(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(line_rules.keep_clean(docs))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, words=5, num=80, den=100).select(*COLUMNS)


@_stage
def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(suffix_dedup.deduplicated(docs))


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _as_documents(mixing.mixed_texts(docs, ["doc_id", "text"]))


@_stage
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pieces.with_pieces(docs.select("doc_id", "source", "text"), pieces.Pieces.load(), out="p")
    return rows.select("doc_id", "source", "p.ids", F.size("p.ids").cast("long").alias("n_tokens"),
                       (F.col("p.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_strings),
          ("mixing sources to target weights", mixture), ("SentencePiece encoding and decoding", encoding)]

#: SQL has none of: seeded block draws by hashes of Spark, Viterbi over a trie.  The stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if last is not None:
            dropped(last)
        last = docs
    return docs
