"""A corpus pipeline: quality rules, near-duplicates, repeated passages, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
`documents`.  A stage's result is written as Parquet and reread as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import bpe, mixing, near_copies, quality, suffix_dedup
from tilewright.llm._common import configure, free_name, scratch, staged, table
from tilewright.llm.vocab import public_path


#: Bytes that must repeat, of their anchors, and fewest words of a passage that is removed.
PASSAGE_BYTES, PASSAGE_ANCHOR, PASSAGE_WORDS = 192, 64, 51


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the limits and the trained verdict keep."""
    configure(spark)
    return quality.kept_rows(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup, completed to every pair of five-word Jaccard similarity of 0.8 or more.  One row of each class of near copies: of the smallest id (null last), then of the smallest row hashes."""
    configure(spark)
    k1, k2 = (free_name(docs.columns, c) for c in ("k1", "k2"))
    with scratch(spark):
        rows = near_copies.classes(docs).groupBy("root", "doc_id", "k1", "k2").count()
        first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2", "count")).alias("first")
        firsts = rows.groupBy("root").agg(first).select(F.col("first.k1").alias(k1), F.col("first.k2").alias(k2), F.col("first.count").alias("times"))
        first = staged(firsts, "first", result=True)
    keyed = docs.withColumns(dict(zip((k1, k2), near_copies.row_keys(docs))))
    kept = keyed.join(first.select(k1, k2), [k1, k2], "left_semi")
    if first.filter("times > 1").limit(1).count():  # whole rows that repeat
        kept = kept.dropDuplicates([k1, k2])
    return kept.select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that occur elsewhere too: runs of at least 51 words that
    repeated strings of 192 bytes cover.  (51 words of under 2.8 letters each may be shorter; such a passage
    stays.)"""
    configure(spark)
    return suffix_dedup.deduplicated(docs, PASSAGE_BYTES, PASSAGE_ANCHOR, PASSAGE_WORDS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (not at all, once or twice)."""
    configure(spark)
    key, copies = (free_name(docs.columns, c) for c in ("k", "copies"))
    keyed = docs.withColumn(key, near_copies.row_keys(docs)[0])  # ids may be null or used again
    with scratch(spark):
        taken = mixing.mixed(keyed, [5, 2, 1], 1.5, id=key).groupBy(F.col("doc_id").alias(key))
        taken = staged(taken.agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(copies + "_rows")).filter(F.col(copies) > 0), "taken", result=True)
    if taken.filter(F.col(copies + "_rows") > 1).limit(1).count():  # whole rows that repeat
        keyed = keyed.dropDuplicates([key])
    rows = keyed.join(taken.select(key, copies), key)
    return rows.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(key)).drop(key)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text as digests, and of what they decode to."""
    configure(spark)
    return bpe.digests(docs, public_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode", encode),
]

#: A trained verdict and BPE are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
