"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poolscope.llm import (collocation, fillmiddle, interpolation, jaccard, langid, linefirst, packing, prefixfree, secretscan,
                           substrings, templates, tokenfiles, urlfilter)
from poolscope.llm.common import crc_remainder, table
from poolscope.session import scratch_path

END_ID = 2


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixfree.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc_remainder("doc_id", 4) == 2)
    net = langid.fit(docs.filter("NOT held_out"))
    return langid.predict(docs.select("doc_id", "text", "held_out"), net).select("doc_id", "held_out", "lang_pred", "score")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenfiles.write_tokens(table(spark, sf_dir, "documents"), folder, path, keep_space=True, end_id=END_ID)
    return tokenfiles.read_digests(spark, folder)


def op5_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, keep_space=False, end_id=END_ID)


def op6_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = interpolation.score_documents(docs.withColumn("train", crc_remainder("doc_id", 7) != 2))
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op7_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefirst.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_kept_lines", "kept_chars")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "word_no", "candidate", "score", "is_secret")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated_words(table(spark, sf_dir, "documents"), with_text=False)


def op12_rollup_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.mine_phrases(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fillmiddle.fill_in_middle(table(spark, sf_dir, "documents"), with_text=False)


QUERIES = {
    "op1_template_decontamination": op1_template_decontamination,
    "op2_prefix_free_parsing": op2_prefix_free_parsing,
    "op3_language_id": op3_language_id,
    "op4_token_files": op4_token_files,
    "op5_retrieval_packing": op5_retrieval_packing,
    "op6_deleted_interpolation": op6_deleted_interpolation,
    "op7_redirect_equivalence": op7_redirect_equivalence,
    "op8_line_cleaning": op8_line_cleaning,
    "op9_secret_scan": op9_secret_scan,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_fm_index": op11_fm_index,
    "op12_rollup_collocations": op12_rollup_collocations,
    "op13_fill_in_middle": op13_fill_in_middle,
}
