"""The registered queries: each applies its operator, with production
parameters, to its whole table and returns the agreed columns."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (audit, collocations, language, lines, mixing, neardup, pieces, pii, quality, spans, suffixes, tokencount,
                        vectors)
from strata.llm.common import ship
from strata.sources.tables import table


def _query(operator):
    @wraps(operator)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return operator(spark, sf_dir)

    return run


def _sha(text):
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def piece_model(path: str | None = None) -> bytes:
    """The SentencePiece model at ``path`` (default: the public 32k one)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.read_model(path)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by PPM code lengths, learned from the rows that
    aren't held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learned(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict by adaptive limits of every document."""
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that three or more of them share."""
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha(F.col("text")).alias("kept_sha256"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its cleaning edits."""
    import public_tokenizers

    ranks = tokencount.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokencount.count_edited(docs, ranks, public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_tokens_before", "n_edits", "n_reencoded", "n_tokens")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without sentences of repeated passages."""
    kept = spans.drop_repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"), grow=True)
    return kept.select("doc_id", "n_sentences", "n_removed", _sha(F.col("text")).alias("kept_sha256"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-duplicate vectors within their label."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    taken = mixing.allocate(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return taken.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return neardup.groups(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it, of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < 4)

    def count(k: int):
        return F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")

    return found.select("doc_id", *[count(k).alias(f"n_{pii.KINDS[k]}") for k in range(4)],
                        _sha(pii.names(base)).alias("base_sha256"), pii.names(F.col("spans")).alias("spans"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, and what they decode to, as digests."""
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), piece_model())
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha(ids).alias("ids_sha256"),
                        _sha(F.col("decoded")).alias("decoded_sha256"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each step of every order of five filters removes, by language."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that a smaller document has."""
    kept = suffixes.drop_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of each language whose words belong together most."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: _query(f) for f in (
    op1_language_id, op2_quality_rules, op3_line_dedup, op4_token_counts, op5_substring_dedup, op6_embedding_near_dedup,
    op7_mixing, op8_minhash_near_dedup, op9_pii, op10_sentencepiece, op11_filter_audit, op12_suffix_array_dedup, op13_collocations)}
