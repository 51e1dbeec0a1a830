"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return
the columns of documents.
"""

from __future__ import annotations

from ordermart.llm import exact_dedup, mixing, packing, simhash, toxicity
from ordermart.llm.common import scratch_path


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.learned(docs, labels))


def drop_exact_copies(spark, docs, sf_dir):
    """One document of each text: the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each SimHash group: the one with the smallest doc_id."""
    return simhash.keep_one(docs)


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark, docs, sf_dir):
    """Power-of-two sequences of at most 1024 ids."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_exact_copies), ("simhash near-dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: a trained classifier, seeded hashes and a tokenizer are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
