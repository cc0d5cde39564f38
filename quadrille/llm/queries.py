"""The queries op1 to op10 with the SQL that checks them, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import attention_lm, byte_bpe, chat_parse, chroma, compress_quality, line_dedup, ngram_join, oracles, packing, quality_rules, secret_scan
from .common import table


def op6_quality_rules(spark, sf_dir):
    """Repetition measures and the verdict for every document."""
    return quality_rules.repetition(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark, sf_dir):
    """Lines that at least three documents hold, dropped from all but the last."""
    return line_dedup.dedup_digest(table(spark, sf_dir, "documents"))


def op1_compression_quality(spark, sf_dir):
    """Every document scored by the two dictionaries."""
    return compress_quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_chroma_fingerprints(spark, sf_dir):
    """Recordings that stand for the vectors of ``embeddings``, fingerprinted; every fiftieth aligned with all, and who is in which class."""
    audio = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("audio"))
    return chroma.aligned_with_members(chroma.fingerprints(audio, "vec_id", chroma.melodies))


def op3_attention_lm(spark, sf_dir, vocabulary: str = "word_bpe_49k.json"):
    """Every document scored by the attention model and by word counts."""
    import public_tokenizers

    return attention_lm.text_scores(table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary))


def op4_secret_scan(spark, sf_dir):
    """Secrets in every document, by pattern and by entropy."""
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark, sf_dir, vocabulary: str = "byte_bpe_multi_50k.tiktoken"):
    """Byte-level BPE ids of every document, and what they decode to."""
    import public_tokenizers

    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)


def op8_chat_format(spark, sf_dir):
    """Conversations written out as transcripts, their roles recovered, rendered canonically."""
    return chat_parse.digests(chat_parse.recovered(table(spark, sf_dir, "conversations")))


def op9_ngram_jaccard(spark, sf_dir):
    """Components of documents whose 4-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark, sf_dir, vocabulary: str = "word_bpe_49k.json"):
    """All documents packed into sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary)))


QUERIES = {f.__name__: f for f in (op1_compression_quality, op2_chroma_fingerprints, op3_attention_lm, op4_secret_scan, op5_byte_bpe, op6_quality_rules, op7_line_dedup, op8_chat_format, op9_ngram_jaccard, op10_best_fit_packing)}
ORACLES = oracles.ORACLES
