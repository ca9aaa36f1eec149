"""A corpus, from raw documents to token ids.

Each stage takes what the one before it kept. A stage's documents are written to the shared folder and
read again, which cuts the lineage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosstally.llm import decontamination, language_id, minhash_dedup, source_mixing, token_output
from crosstally.llm.common import kept, ready, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents without text or without a letter, whatever languages could be learned."""
    model = language_id.fitted(ready(spark) and docs)
    row = docs.select(F.struct("*").alias("_row"), "text")
    return language_id.predict(row, model).where("has_letter").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group: shingles of five words, a similarity of 0.8."""
    ready(spark)
    return minhash_dedup.deduplicated(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents of which a twentieth or more are words of benchmark passages."""
    row = docs.select(F.struct("*").alias("_document"), "text")
    found = decontamination.contamination(row, table(spark, sf_dir, "benchmark"), carry=["_document"])
    return found.where(~F.col("contaminated")).select("_document.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ready(spark)
    return source_mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' content: where each document begins, its size and its checksum."""
    return token_output.token_output(ready(spark), docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has no tokenizer; tests compare each stage with a brute-force version.
ORACLE_SQL = None
