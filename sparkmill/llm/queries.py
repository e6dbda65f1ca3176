"""The registered queries of the training-data operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmill.llm import collocations, decontam, infill, jaccard, licenses, quality, secrets, segment, substring, tokenfile, topk, toxicity, warc
from sparkmill.llm.store import folder, stored
from sparkmill.sources.tables import table


def _tokenizer(name: str) -> str:
    """Place of one of the public tokenizers' files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    captures = stored(warc.assemble(warc.read_records(spark, path, payloads=False)), "captures")
    return warc.resolve_revisits(captures)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents")).drop("text_hash", "root")


def op4_sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segmentations(table(spark, sf_dir, "documents"))


def segmentations(docs: DataFrame) -> DataFrame:
    """Sampled segmentations of every text, decoded again and compared with it."""
    return segment.round_trips(docs, _tokenizer("piece_bpe_32k.model"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("items", "spans")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), path, _tokenizer("word_bpe_49k.json"))
    return tokenfile.read_tokens(spark, path)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.drop_repeated_passages(table(spark, sf_dir, "documents"))
    return out.drop("kept_text")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.report(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc_transactions": op2_warc_transactions,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_sampled_segmentation": op4_sampled_segmentation,
    "op5_exact_topk": op5_exact_topk,
    "op6_decontamination": op6_decontamination,
    "op7_token_files": op7_token_files,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality": op9_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_license_scan": op12_license_scan,
    "op13_collocations": op13_collocations,
}
