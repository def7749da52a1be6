"""Corpus pipeline over ``documents``.

toxicity -> quality rules -> near duplicates -> benchmark decontamination ->
SentencePiece ids.  Every stage takes (spark, docs, sf_dir) and works on all rows
that its predecessor kept; all but the last return the columns of ``documents``.
Stages are written to the shared folder and read again, so each runs once and a
lost executor only repeats its own tasks.
"""

from __future__ import annotations

import public_tokenizers

from panelwatch.llm import decontaminate, near_dedup, quality, sentencepiece_codec, toxicity
from panelwatch.llm.common import stage, table


def remove_toxic(spark, docs, sf_dir):
    """Drops documents whose score reaches the cut of their language (model trained on ``labels``)."""
    return toxicity.remove_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_good(spark, docs, sf_dir):
    """Drops documents that fail the base rule or a quality rule."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark, docs, sf_dir):
    """Keeps one document of each near-duplicate component, the one with the smallest id."""
    return near_dedup.deduplicate(docs)


def decontaminated(spark, docs, sf_dir):
    """Drops documents of which a twentieth or more lies in benchmark windows."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark, docs, sf_dir):
    """doc_id, piece ids and their number."""
    return sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", remove_toxic),
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("sentencepiece", tokenized),
]

#: SQL cannot express the classifier, the joins and the encoder; tests compare with brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
