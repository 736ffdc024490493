"""Queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import fingerprints, hard_negatives, html_text, licences, line_rules, mixing, ngram_join, oracle, pieces, shards, spelling, suffix_dedup, tree_weighting, url_rules
from tessera.llm.common import documents, ship_package
from tessera.sources.tables import read_table


QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return fn
    return register


@query("op6_hash_tree_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text")
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = d.select("doc_id", (F.length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                    F.lit("key").alias("law"))
    root = shards.tree()
    rows = shards.placed(rows, root, "doc_id")
    rows = shards.placed(rows, shards.grown(root), "doc_id", "grown_shard")
    return shards.with_slots(rows, "shard", ["doc_id", "text_crc32"]) \
        .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query("op8_line_rules", oracle.OP8)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text")
    return line_rules.with_line_rules(d, "q").select("doc_id", "q.*")


@query("op5_mix_blocks")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text", "source")
    d = d.withColumn("sig", F.xxhash64("text"))  # rows of one id are told apart, so reruns lay them out alike
    laid, of, mix = mixing.mixed_blocks(d, ["doc_id", "sig"])
    return mixing.placed_words(laid, of, mix).select("doc_id", "size", "source_size", "target", "taken", "places")


@query("op2_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_next(documents(spark, sf_dir, "doc_id", "text"))


@query("op7_html_density")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return html_text.with_main_text(p).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op3_pieces")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text")
    rows = pieces.with_pieces(d, pieces.Pieces.load(), out="p")
    return rows.select("doc_id", F.size("p.ids").cast("long").alias("n_tokens"), "p.n_byte_pieces", "p.ids",
                       F.sha2(F.encode("p.decoded", "UTF-8"), 256).alias("decoded_sha256"),
                       (F.col("p.decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query("op4_tree_weighting")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_weighting.score(documents(spark, sf_dir, "doc_id", "text"))


@query("op1_ngram_join", oracle.OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text")
    return ngram_join.similar(d).select("doc_id", "n_shingles", "component_id")


@query("op10_suffix_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal(documents(spark, sf_dir, "doc_id", "text"))


@query("op9_licences")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text")
    rows = licences.scanned(d, licences.trained(d))
    sure = F.filter("notices", lambda x: x["confirmed"])
    return rows.select("doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_notices"),
                       F.size(sure).cast("long").alias("n_confirmed"),
                       F.size(F.filter("notices", lambda x: x["family"] == "unknown")).cast("long").alias("n_unknown"),
                       F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))).alias("families"))


@query("op11_spelling_variants", oracle.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(documents(spark, sf_dir, "doc_id", "text"), misspelt=97)
    return spelling.variants(words)


@query("op12_hard_negatives", oracle.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    rows = hard_negatives.usable(e, "vec_id", "label", "embedding")
    rows = rows.select("id", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
                       F.transform("vector", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    return hard_negatives.mined(rows, F.col("id") % 100 == 0)


@query("op13_url_rules", oracle.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(read_table(spark, sf_dir, "pages", ["page_id", "url"]), url_rules.rule_table(spark))
