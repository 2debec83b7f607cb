"""The operators over the whole tables they are meant for, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from allocspark.llm import (
    bpe, centroids, collocations, exact_dedup, fingerprint, html_extract, language, minhash, packing, pii, pipeline, quality, toxicity,
    url_filter)
from allocspark.llm.common import read_table, tokenizer_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts of ``documents`` stays."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract_main_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudonyms under a public key, for trials: the pipeline and production runs take a secret one."""
    return pii.pseudonymise_column(read_table(spark, sf_dir, "documents").select("doc_id", "text"), pii.TRIAL_KEY)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the text decoded from them."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.with_digests(bpe.encode_decode(documents, tokenizer_path("word_bpe_49k.json")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, from models of ``documents``."""
    languages, models = language.learn_text_models(read_table(spark, sf_dir, "documents"))
    return language.identify(read_table(spark, sf_dir, "pages"), languages, models)


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of ``documents`` linked by a similarity of 0.8 on four-word shingles."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, percent=80)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of ``documents``, drawn by how alike they are to those labelled good."""
    return quality.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels that aren't held out."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(documents, read_table(spark, sf_dir, "labels"))
    scored = toxicity.toxicity(documents, lexicon)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), with_ids=False)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.edit_probe(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of ``documents``."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of all usable vectors of ``embeddings`` after five rounds."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the five fixed entries on every url of ``pages``."""
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), url_filter.rule_table(spark, url_filter.RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_html_extraction, op3_pii, op4_bpe, op5_language_id, op6_near_dedup, op7_quality,
        op8_toxicity, op9_packing, op10_fingerprints, op11_collocations, op12_centroids, op13_url_filter)
} | {"pipeline": pipeline.run}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.ORACLE_SQL, "op11_collocations": collocations.ORACLE_SQL, "op12_centroids": centroids.ORACLE_SQL,
    "op13_url_filter": url_filter.ORACLE_SQL}
