"""Documents to packed training sequences, in five stages; each reads what the one before has written.

quality and toxicity drop the documents that their classifiers reject; exact_dedup keeps one of equal texts;
near_dedup keeps one document of each SimHash group; packing returns the pieces of the rest by sequence.
Classifiers learn from the labels of the documents that reach their stage, with the folds of the queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from captionloom.llm.common import Work, table
from captionloom.llm.exact_dedup import exact_dedup, without_spaces
from captionloom.llm.packing import best_fit_packing
from captionloom.llm.quality_crf import score_quality
from captionloom.llm.queries import tokenizer_file
from captionloom.llm.simhash_dedup import simhash_dedup
from captionloom.llm.toxicity import score_toxicity


def free(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until docs has no such column."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents predicted to be of good quality.

    Every row is judged by its own text (null: empty), so repeated rows stay or go together, whatever their ids; without
    labels of both kinds all rows have one score. An empty table stays empty. Other columns are handed on.
    """
    scored = score_quality(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents not predicted to be toxic. Nulls, repeated rows and empty tables as in quality()."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 0").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of the documents that are equal but for white space: the longest, then the smallest id (null last).

    Null texts are empty, and all empty texts are equal. Ids may be null and may repeat, and of rows alike in both one
    stays. An empty table stays empty. Other columns are handed on.
    """
    work = Work(spark, "pipeline-exact")
    found = work.save(exact_dedup(docs).select("doc_id", "kept", "text_sha256"), "found")
    ids = found.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if ids[0] == ids[1]:
        return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    # ids that repeat or are null do not name a row: the text has to match too, and of rows alike one stays
    id_, sha, kept_sha, n = free(docs, "_id", "_sha", "_kept", "_n")
    kept = found.where("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(kept_sha))
    own = F.sha2(without_spaces(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256)
    rows = docs.withColumn(sha, own).join(kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    alike = Window.partitionBy("doc_id", sha).orderBy(F.length("text").desc(), "text")
    return rows.withColumn(n, F.row_number().over(alike)).where(F.col(n) == 1).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of near copies, the document with the smallest id (null last).

    Null texts are empty; texts without words are one group. Ids may be null and may repeat: then one row of each group
    stays, that with the smallest id, of these the longest. An empty table stays empty. Other columns are handed on.
    """
    work = Work(spark, "pipeline-near")
    ids = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.countDistinct("doc_id")).first()
    if not ids[0] == ids[1] == ids[2]:
        # ids that repeat or are null do not name a row: rows are numbered, and of each group one stays
        row, group, n = free(docs, "_row", "_group", "_n")
        rows = work.save(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        found = work.save(simhash_dedup(rows.select(F.col(row).alias("doc_id"), "text")), "found")
        groups = found.select(F.col("doc_id").alias(row), F.col("component_id").alias(group))
        first = Window.partitionBy(group).orderBy(F.col("doc_id").asc_nulls_last(), F.length("text").desc(), "text")
        least = rows.join(groups, row).withColumn(n, F.row_number().over(first))
        return least.where(F.col(n) == 1).select(docs.columns)
    found = work.save(simhash_dedup(docs).select("doc_id", "component_id"), "found")
    gone = found.where("doc_id <> component_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, by sequence and offset. A null text is empty and gives the end id; repeated rows are
    packed as they are; an empty table gives no rows. Other columns are not handed on."""
    return best_fit_packing(docs, tokenizer_file("word_bpe_49k.json"), keep_ids=False)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("packing", packing),
]

#: SQL can express neither the classifiers nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. Every stage's output is written to the shared folder and read again."""
    docs, work = table(spark, sf_dir, "documents"), Work(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k > 0:
            work.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
