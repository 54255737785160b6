"""The corpus pipeline: five stages, each one operator of ``roadframe.llm`` over all rows its predecessor kept.

Every stage function takes (spark, docs, sf_dir) and returns a DataFrame; the
first four return the columns of their input, and fewer rows. ``run`` writes
each stage's result as Parquet in the shared folder and reads it as the next
one's input, so a lost executor costs no more than a stage's task.

Each stage follows its operator's defined cases: null and empty texts fail the
quality rules and go there; null ids and repeated rows are rows like others; an
empty table passes through as an empty table; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadframe.llm import bpe, common, decontaminate, pu_quality, quality_rules, simhash_gph
from roadframe.session import read_table

SHINGLE, MAX_BITS = 4, 4


def _carry(docs: DataFrame, *inputs: str) -> DataFrame:
    """The operator's inputs under their own names, all other columns under names that no operator uses."""
    return docs.select([F.col(f"`{c}`").alias(c if c in inputs else f"__llm_in_{i}") for i, c in enumerate(docs.columns)])


def _restore(out: DataFrame, docs: DataFrame, *inputs: str) -> DataFrame:
    return out.select([F.col(c) if c in inputs else F.col(f"__llm_in_{i}").alias(c) for i, c in enumerate(docs.columns)])


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    narrow = _carry(docs, *(inputs := ("doc_id", "text", "lang")))
    judged = quality_rules.keep(narrow, read_table(spark, sf_dir, "labels"))
    return _restore(judged, docs, *inputs)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier scores at its threshold or higher."""
    narrow = _carry(docs, *(inputs := ("doc_id", "text")))
    scored = pu_quality.score_documents(narrow, read_table(spark, sf_dir, "labels")).where(F.col("score") >= pu_quality.THRESHOLD)
    return _restore(scored, docs, *inputs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of smallest id."""
    return simhash_gph.deduplicate(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    narrow = _carry(docs, "text")
    found = decontaminate.find(narrow, read_table(spark, sf_dir, "benchmark")).where(F.size("spans") == 0)
    return _restore(found, docs, "text")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, the ids' number, and the text that the ids decode to."""
    return bpe.encode_decode(docs, bpe.word_bpe()).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: Fingerprints, the classifier and BPE are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
