"""One query per operator: the operator over its whole table, and the digests of its results."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import conversation_repair, exact_dedup, fingerprints, html_extraction, language_model
from jobtide.llm import line_dedup, packing, quality
from jobtide.llm import sentencepiece_lattice as lattice
from jobtide.llm import simhash_dedup, token_alignment, url_filter, warc
from jobtide.llm.common import ship, table, working_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def _print(hi: str, lo: str):
    return F.concat(*(F.lpad(F.lower(F.hex(c)), 16, "0") for c in (hi, lo)))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.with_near_counts(fingerprints.document_fingerprints(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _print("hi", "lo").alias("fingerprint"),
        _print("edited_hi", "edited_lo").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(spark, table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{working_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    found = warc.page_payloads(warc.reassembled(warc.read_records(spark, path)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", predicted)


def op10_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and what they decode to, as digests."""
    vocabulary = lattice.load_vocabulary(tokenizer_file("piece_bpe_32k.model"), merges=True)
    return lattice.encode_documents(table(spark, sf_dir, "documents"), vocabulary).drop("ids")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoding of every distinct word of the documents, how often it occurs, and its decoding."""
    vocabulary = lattice.load_vocabulary(tokenizer_file("piece_bpe_32k.model"), merges=True)
    found = lattice.encode_words(lattice.word_counts(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    text = lattice.decoded(F.col("ids"), F.col("lead"), vocabulary).alias("decoded")
    return found.select("word", "lead", "n", "ids", F.size("ids").alias("n_pieces"), text)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"), html_extraction.trained())


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [tokenizer_file(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.align(table(spark, sf_dir, "documents"), *files)


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _shipped(f)
    for f in (
        op1_line_dedup,
        op2_exact_dedup,
        op3_document_fingerprints,
        op4_simhash_near_dedup,
        op5_url_filter,
        op6_packing,
        op7_lm_scoring,
        op8_warc,
        op9_quality_classifier,
        op10_documents,
        op10_sentencepiece,
        op11_conversation_repair,
        op12_html_extraction,
        op13_token_alignment,
    )
}
