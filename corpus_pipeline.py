"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, token ids.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that
is written as Parquet and read again as the next one's docs. All but the last return the columns of
`documents`. `run` applies them to the table `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import bpe_transducer, line_dedup, simhash_trees, spaced_seeds, weak_quality
from wardflow.llm.common import table
from wardflow.llm.queries import vocabulary
from wardflow.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality passes."""
    return weak_quality.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line; a document that loses all its words goes.

    Texts that lose a line get their length in n_chars; all others stay as they are, NULL included.
    """
    rest = [c for c in docs.columns if c != "text"]
    held = docs.select("doc_id", "text", F.col("text").isNull().alias("was_null"), F.struct(*rest).alias("row"))
    cut = line_dedup.dedup_lines(held).filter(F.col("text").rlike(r"[^\x20\x09-\x0D]") | (F.col("n_removed") == 0))
    new = {"text": F.when(~F.col("was_null"), F.col("text")), **{c: F.col(f"row.{c}") for c in rest}}
    if "n_chars" in rest:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))
    return cut.select(*[new[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_trees.keep_first(docs, shingle=4, radius=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the table `benchmark`."""
    return spaced_seeds.keep_clean(docs, table(spark, sf_dir, "benchmark"), short_items=True)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of each document and the digest of the text they give back."""
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    return bpe_transducer.encoded_and_decoded(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("byte-level bpe", token_ids),
]

#: Similarity of fingerprints and byte-pair encoding have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
