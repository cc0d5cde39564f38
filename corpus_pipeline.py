"""The corpus pipeline: five stages, each on all that the one before kept."""

from __future__ import annotations

from quadrille.llm import line_dedup, ngram_join, packing, quality_rules, secret_scan
from quadrille.llm.common import written


def quality(spark, docs, sf_dir):
    """Documents that the repetition rules reject go."""
    return quality_rules.passing(docs)


def lines(spark, docs, sf_dir):
    """Lines that three documents or more hold stay in the last one only."""
    return line_dedup.dedup_texts(docs)


def near_duplicates(spark, docs, sf_dir):
    """Of each group of documents linked by 5-word shingles at 0.8, the one with the smallest doc_id stays."""
    return ngram_join.representatives(docs, 5, 80)


def secrets(spark, docs, sf_dir):
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redacted(docs)


def sequences(spark, docs, sf_dir):
    """All documents as pieces of sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_jaccard", near_duplicates), ("secret_scan", secrets), ("best_fit_packing", sequences)]

#: The packing and the groups of near copies can't be had from SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
