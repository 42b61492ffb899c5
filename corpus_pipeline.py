"""A training corpus from raw documents: each stage reads what the one before it has written.

Each function takes (spark, docs, sf_dir). A document is a row; all stages but the last return the
columns of ``documents``. Rows with null or empty texts pass the filters unless the classifier
rejects them, and an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, jaccard_join, line_dedup, quality_classifier
from tallyframe.llm.queries import packed_digests, quality_labels
from tallyframe.sources.tables import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled ones vote for."""
    model = quality_classifier.fit(docs, quality_labels(spark, sf_dir))
    scored = quality_classifier.score(docs.withColumnRenamed("score", "__score"), model)
    return scored.where(F.col("score") >= quality_classifier.THRESHOLD).drop("score").select(
        *[F.col("__score").alias("score") if c == "score" else F.col(c) for c in docs.columns]
    )


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group; texts without a word are kept.

    Rows that share this doc_id stay together, but of those that are equal one stays.
    """
    first = F.col("doc_id").eqNullSafe(F.col("class_id"))
    ids = jaccard_join.jaccard_join(docs).groupBy(F.col("doc_id").alias("__id")).agg(F.count_if(first).alias("__n"))
    # far fewer documents go than stay, so the texts meet the shorter list
    other = materialise(ids.where("__n <> 1"), "other-ids")
    same = docs["doc_id"].eqNullSafe(other["__id"])
    once = docs.join(other, same, "left_anti")
    again = docs.join(other.where("__n > 1"), same, "left_semi")
    return once.unionByName(again.dropDuplicates())


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of 1024 tokens."""
    return packed_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

#: The stages use fitted models, hashes and a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
