"""The corpus pipeline: five operators of ``hospiq.llm`` one after the other.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents``; the last returns the mix, which says for each
document how many words it takes. Every stage judges all rows that its predecessor
kept. Between stages the rows are written to the shared folder as Parquet and
read back, so a lost executor costs a read, not a recomputation.

Nulls, empty texts, repeated rows and empty tables are handled as the operators
state; columns beyond those of ``documents`` pass through all stages but the
last, whatever their names.
"""

from __future__ import annotations

from hospiq.llm import decontam, exact_dedup, langid, mixing, near_dedup
from hospiq.llm.common import materialize, read_table, ship_package


def language_id(spark, docs, sf_dir):
    """Drops documents of no language: without a letter, junk, or none learned."""
    ship_package(spark)
    return langid.keep_identified(spark, docs)


def exact_copies(spark, docs, sf_dir):
    """Keeps of equal texts the longest original, then the smallest doc_id."""
    ship_package(spark)
    return exact_dedup.drop_exact_copies(spark, docs)


def near_copies(spark, docs, sf_dir):
    """Keeps one text of each group of near copies, the smallest doc_id's (the
    operator's links: two-word shingles, similarity 0.8; null ids come last)."""
    ship_package(spark)
    return near_dedup.drop_near_copies(spark, docs)


def decontaminate(spark, docs, sf_dir):
    """Drops documents with a benchmark item in them."""
    ship_package(spark)
    return decontam.drop_leaks(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """The mix of what is left: ``doc_id, source, size, source_size, target,
    taken`` of every document; taken 0: the mix takes no word of it."""
    ship_package(spark)
    return mixing.mix(docs)[0]


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
]

# MinHash, the trained network and the pseudorandom mix are not SQL; tests hold
# each stage and the whole against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
