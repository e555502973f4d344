"""Corpus pipeline: from raw documents to packed sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written out and reread as the next one's docs.
All but the last return the columns of ``docs``; each stage works on every row
that its predecessor kept, and what it decides takes effect:

1. toxicity: rows that score 0.3 or more go (operator 6);
2. near_dedup: of each group of near duplicates one document stays (operator 9);
3. substring_dedup: passages that repeat an earlier document are cut out of the
   text; a document of which nothing is left goes (operator 4);
4. decontamination: documents that hold a benchmark window go (operator 7);
5. packing: pieces of the rest with their sequence and place (operator 10).

Null ids are kept as ids of their own, null texts count as empty, an empty table
stays empty; extra columns pass through the filtering stages.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from geoqa.llm import op4_substrings, op6_toxicity, op7_decontaminate, op9_minhash, op10_pack  # noqa: E402
from geoqa.llm.common import stored, table  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bags, share = op6_toxicity.training_sample(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    return op6_toxicity.without_toxic(docs, op6_toxicity.train(bags, share))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_minhash.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans = op4_substrings.repeated_passages(docs)
    return op4_substrings.without_passages(docs, spans, size_col="n_chars")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return op10_pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL cannot express the classifier, the alignment or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
