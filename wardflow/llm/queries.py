"""One query per operator over the given tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.llm import (
    bpe_transducer,
    collision_search,
    conversation_repair,
    html_difference,
    license_rules,
    line_dedup,
    pii_bootstrap,
    simhash_trees,
    spaced_seeds,
    url_rules,
    weak_quality,
    word_runs,
    zstd_tokens,
)
from wardflow.llm.common import table
from wardflow.session import fresh_path, settle


#: What the URL filter is given: fixed values.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_difference.extract(table(spark, sf_dir, "pages"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence rules that the documents meet."""
    return license_rules.scan(table(spark, sf_dir, "documents"))


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base matches and what trusted contexts add."""
    return pii_bootstrap.digests(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item, with two of twelve tokens free to differ."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return spaced_seeds.overlaps(docs, benchmark, short_items=True)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and the weakly supervised verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measured = settle(weak_quality.features(docs).drop("text"))
    return weak_quality.judge(measured, weak_quality.posteriors(measured)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def vocabulary(name: str) -> bytes:
    """A vocabulary file, read once by the driver; a few megabytes at most."""
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op6_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document written to files of zstandard frames, and what the files then hold."""
    path = fresh_path(spark, "tokens")
    zstd_tokens.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    return zstd_tokens.summarise(spark, path)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URL_RULES)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and their way back: counts and digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_transducer.digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier line of any document."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and linked group of every document: four-word shingles, four bits."""
    found = simhash_trees.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after damage that is planted by a checksum."""
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors nearest to every twentieth, by inner product."""
    rows = table(spark, sf_dir, "embeddings")
    return collision_search.nearest(rows, rows.filter(F.col("vec_id") % 20 == 0), k=20)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, a tenth of which has periods planted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return word_runs.word_runs(docs, spoil=word_runs.repeat_tail, key="doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_license_scan,
        op3_pii_bootstrap,
        op4_decontamination,
        op5_quality_rules,
        op6_token_frames,
        op7_url_filter,
        op8_byte_bpe,
        op9_line_dedup,
        op10_simhash_near_dedup,
        op11_conversation_repair,
        op12_nearest_neighbours,
        op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {"op2_license_scan": license_rules.scan_sql()}
