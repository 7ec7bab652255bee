"""Queries of the corpus operators: production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fintide.llm import ann, chaining, collocations, hard_negatives, langid, line_dedup, mixing, oracles, packing, pii, quality, quotation, simhash, url_filter
from fintide.llm.common import read_table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.listed_urls(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


def op2_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.conversations(read_table(spark, sf_dir, "conversations"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    placed = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), counts=True)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = mixing.mix_report(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "source", "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge(docs, quality.trusted(read_table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "llr_score")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read_table(spark, sf_dir, "documents")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages_by_document(read_table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.learn(docs.filter(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    whole = F.transform("embedding", lambda x: hard_negatives.floored(256 * x.cast("double")))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), vec_id, moved, whole, F.col("id") % 100 == 0)


def queries() -> dict:
    import corpus_pipeline

    found = {f.__name__: f for f in (
        op1_url_filter, op2_nearest_vectors, op3_quotation_linking, op4_best_fit_packing, op5_simhash_near_dedup,
        op6_line_dedup, op7_mixing, op8_quality_rules, op9_personal_data, op10_substring_dedup, op11_language_id,
        op12_collocations, op13_hard_negatives)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    found = {"op1_url_filter": oracles.OP1, "op3_quotation_linking": oracles.OP3,
             "op6_line_dedup": oracles.OP6, "op12_collocations": oracles.OP12, "op13_hard_negatives": oracles.OP13}
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
