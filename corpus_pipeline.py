"""The corpus pipeline: quality classifier, near-dedup, substring dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of ``documents``; the last returns the packed pieces. ``run`` writes every stage's result
to the shared folder and rereads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import cotrain, decontam, neardup, packing, substring
from panelcast.llm.common import table, unpacked, written
from panelcast.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the co-trained classifier rejects as low quality or toxic."""
    judged = cotrain.classify(docs, cotrain.fit(docs, table(spark, sf_dir, "labels")))
    return judged.where("kept").select(*unpacked(judged, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of every group of near-duplicates (five-word shingles, 0.8)."""
    gone = neardup.find_groups(docs, shingle=5, percent=80).where("not kept").select("key").distinct()
    keyed = docs.withColumn("__near_key", neardup.row_key("doc_id", "text"))
    kept = keyed.join(gone, F.col("__near_key") == gone["key"], "left_anti").select(*docs.columns)
    # the next stage works on blocks of consecutive ids: give it few blocks per task
    return kept.repartitionByRange("doc_id")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words that occur earlier; what is left of such a text is joined by single spaces."""
    return substring.cut_repeats(docs, width=50)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark items."""
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), width=13, share=20)
    return found.where("not contaminated").select(*unpacked(found, docs.columns))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences of 1024 ids."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0, length=1024)


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_overlap),
    ("packing", sequences),
]

#: SQL can express neither the classifier nor the min-hash trees: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
