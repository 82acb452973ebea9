"""A training-corpus pipeline over ``documents``; its stages call chainwatch.llm.

Every stage but the last returns the columns of its input and the rows that
stay; each result is written as Parquet and reread as the next stage's input."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from chainwatch.llm import bpe, decontaminate, exact_dedup, langid, near_dedup
from chainwatch.llm._common import read_table, unused, written

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def known_language(spark, docs, sf_dir):
    """Language ID: documents go that are in no learned language; the model is
    learned from the labelled ones among them."""
    return langid.drop_rejected(docs, langid.fit(docs))


def drop_copies(spark, docs, sf_dir):
    """Exact dedup: of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark, docs, sf_dir):
    """MinHash near-dedup: of linked documents, the smallest doc_id stays."""
    return near_dedup.drop_near(docs)


def drop_benchmark(spark, docs, sf_dir):
    """Benchmark decontamination: documents that hold a test item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark, docs, sf_dir):
    """BPE: number of tokens, digests of the ids and of the text decoded from them."""
    ids, decoded = unused(docs, "ids"), unused(docs, "decoded")
    coded = bpe.encode(docs, BYTE_BPE, ids=ids, decoded=decoded)
    new = {
        "n_tokens": (F.octet_length(ids) / 4).cast("bigint"),
        "ids_sha256": F.sha2(ids, 256),
        "decoded_sha256": F.sha2(decoded, 256),
    }
    return coded.select(*(c for c in docs.columns if c not in new), *(x.alias(c) for c, x in new.items()))


STAGES = [
    ("language", known_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("bpe", tokenise),
]

#: Language inference, near-duplicate links and BPE have no SQL form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in turn over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
